"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestar.llm import (catalog, components, decontaminate, embedding_dedup, language_model, ngram_join, packing, quality, records,
                          substring_dedup, token_counts, url_filter)

rng = random.Random(11)
W = [f"w{i}" for i in range(60)]
say = lambda n: " ".join(rng.choices(W, k=n))
COMMON, BASE = say(45), say(120)
NEAR = [" ".join(["new" if j == i * 7 else w for j, w in enumerate(BASE.split())]) for i in range(6)]
TEXTS = [None, "", "  \n ", "one", "one two", "One TWO", say(30), BASE, BASE, *NEAR, "x " + COMMON + " y", COMMON + " " + say(20), say(15) + " " + COMMON,
         "go " * 300, say(4000), BASE + " " + say(60), "tail " * 36, "É! a.b\tc\x0bd", "w1 w2 w3 w4"]
ROWS = [(i, t, "en", i) for i, t in enumerate(TEXTS)] + [(7, BASE, "en", 7), (None, BASE, None, None), (None, None, None, None), (-5, NEAR[0], "de", 0)]
SCHEMA = "doc_id LONG, text STRING, lang STRING, n_chars LONG"


def stored(spark, rows=ROWS, schema=SCHEMA):
    """Read from files, as the operators want it, with columns that clash with results and inner names."""
    df = components.stored(spark.createDataFrame(rows, schema), "test-docs")
    for c in ("score", "n_words", "items", "spans", "n_tokens", "component", "node", "key", "batch", "known", "best"):
        df = df.withColumn(c, F.lit("own"))
    return df


def words(t):
    return (t or "").encode().split()


def low(t):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())


@pytest.fixture(scope="module")
def docs(spark):
    return stored(spark)


@pytest.fixture(scope="module")
def none(spark):
    return stored(spark, [])


def closure(n, links):
    part = list(range(n))
    def find(i):
        while part[i] != i:
            i = part[i]
        return i
    for a, b in links:
        part[find(a)] = find(b)
    return [find(i) for i in range(n)]


def brute_components(texts, size, threshold):
    sets = []
    for t in texts:
        w = low(t).split()
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]
    return sets, closure(len(sets), links)


@pytest.mark.parametrize("size,threshold", [(4, 85), (5, 80), (2, 50)])
def test_ngram_components(docs, size, threshold):
    sets, part = brute_components([r[1] for r in ROWS], size, threshold)
    low_id = {p: min((ROWS[i][0] for i in range(len(ROWS)) if part[i] == p and ROWS[i][0] is not None), default=None) for p in set(part)}
    expect = Counter((r[0], len(s), low_id[p] if s else r[0]) for r, s, p in zip(ROWS, sets, part))
    got = ngram_join.ngram_components(docs, size, threshold)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == expect


def test_ngram_components_of_random_near_copies(spark):
    base = [say(40).split() for _ in range(3)]
    texts = []
    for _ in range(90):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = f"n{rng.randint(0, 9)}"
        texts.append(" ".join(t))
    df = stored(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    sets, part = brute_components(texts, 4, 70)
    first = {p: min(i for i in range(len(texts)) if part[i] == p) for p in set(part)}
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(df, 4, 70).collect()}
    assert got == {i: first[part[i]] for i in range(len(texts))}


def test_one_of_each(docs, none):
    sets, part = brute_components([r[1] for r in ROWS], 5, 80)
    got = ngram_join.one_of_each(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    full = [r for r in rows if words(r["text"])]
    assert len(full) == len({p for p, s in zip(part, sets) if s}) and len(rows) - len(full) == sum(not s for s in sets)
    assert ngram_join.one_of_each(none).count() == 0


@pytest.mark.parametrize("size,hot", [(35, 40_000), (35, 0), (5, 200)])
def test_substring_dedup(docs, size, hot):
    count = Counter(tuple(w[i:i + size]) for w in (words(r[1]) for r in ROWS) for i in range(len(w) - size + 1))
    expect = []
    for r in ROWS:
        w = words(r[1])
        gone = {j for i in range(len(w) - size + 1) if count[tuple(w[i:i + size])] > 1 for j in range(i, i + size)}
        expect.append((r[0], len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    got = substring_dedup.remove_repeated(docs, size, hot_words=hot, shard_words=300)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got.collect()) == Counter(expect)
    assert set(docs.columns) <= set(got.columns)


def test_records(spark, docs):
    out = records.token_records(spark, docs, catalog.tokenizer_file("byte_bpe_50k.json"), end_id=2).collect()
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(catalog.tokenizer_file("byte_bpe_50k.json"))
    ids = [(r[0], [*t.encode(r[1] or "", add_special_tokens=False).ids, 2]) for r in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))]
    start, expect = 0, []
    for doc, x in ids:
        expect.append((doc, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    assert Counter((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in out) == Counter(expect)


def test_benchmark(spark, docs):
    bench = spark.createDataFrame([(1, COMMON), (2, "one"), (3, None), (4, ""), (None, "É A B"), (1, say(12)), (5, COMMON)], "item_id LONG, text STRING")
    one = decontaminate.find_benchmark(docs, bench, size=10)
    many = decontaminate.find_benchmark(docs, bench, size=10, shard_bytes=60)
    key = lambda shards: lambda df: Counter((r["doc_id"], r["n_words"], r["h"], tuple(sorted(r["items"]))) for r in df.withColumn("h", decontaminate.hit_words()).collect())
    assert key(1)(one) == key(2)(many)
    found = {r["doc_id"]: r["items"] for r in one.collect()}
    assert sorted(found[15]) == ["1", "5"] and sorted(found[5]) == ["2"] and found[22] == [""] and found[6] == []
    clean = decontaminate.without_benchmark(docs, bench)
    assert clean.columns == docs.columns and clean.count() == one.where("size(spans) = 0").count()
    assert decontaminate.find_benchmark(docs, bench.where("false")).where("size(spans) > 0").count() == 0


def test_decontamination_query_with_several_shards(spark, monkeypatch):
    """The query's own columns do not depend on the number of shards, also when items of two shards hit the same words."""
    docs = spark.createDataFrame([(1, f"x {COMMON} y {COMMON}"), (2, None), (3, say(30)), (4, COMMON[:60])], "doc_id LONG, text STRING")
    half = " ".join(COMMON.split()[8:30])
    bench = spark.createDataFrame([*[(i, COMMON) for i in range(6)], (9, half), (10, "x")], "item_id LONG, text STRING")
    monkeypatch.setattr(catalog, "table", lambda spark, sf_dir, name: {"documents": docs, "benchmark": bench}[name])
    one = Counter(catalog.op4_decontamination(spark, "").collect())
    inner = decontaminate.find_benchmark
    monkeypatch.setattr(decontaminate, "find_benchmark", lambda *a, **k: inner(*a, **k, shard_bytes=400))
    many = catalog.op4_decontamination(spark, "").collect()
    assert Counter(many) == one
    assert {r["doc_id"]: r["n_hit"] for r in many}[1] == 91
    spans = next(r["spans"] for r in decontaminate.find_benchmark(docs, bench).collect() if r["doc_id"] == 1)
    assert [(s["start"], s["end"]) for s in spans] == [(0, 46), (47, 92)]


def test_benchmark_shards_are_bounded(spark, monkeypatch):
    """Repeated rows are collected once, a long item in parts, and no window is lost."""
    long = say(400)
    docs = spark.createDataFrame([(1, f"x {long} y"), (2, " ".join(long.split()[150:175])), (3, COMMON)], "doc_id LONG, text STRING")
    bench = spark.createDataFrame([(1, long), *[(2, COMMON)] * 200, (3, None), (4, "one two")], "item_id LONG, text STRING")
    sizes, inner = [], decontaminate.prepare
    monkeypatch.setattr(decontaminate, "prepare", lambda texts, *rest: sizes.append(sum(len(t or "") for t in texts)) or inner(texts, *rest))
    found = {r["doc_id"]: r for r in decontaminate.find_benchmark(docs, bench, shard_bytes=600).withColumn("h", decontaminate.hit_words()).collect()}
    assert max(sizes) <= 600 and len(sizes) > 1
    assert [(found[i]["h"], found[i]["items"]) for i in (1, 2, 3)] == [(400, ["1"]), (25, ["1"]), (45, ["2"])]


def test_near_vectors(spark):
    r = np.random.default_rng(12)
    base = r.standard_normal((12, 24))
    data = [(i, (base[i % 12] + 0.02 * r.standard_normal(24)).tolist()) for i in range(60)]
    data += [(100, data[0][1]), (100, data[0][1]), (None, data[1][1]), (101, [2 * x for x in data[2][1]])]
    data += [(102, None), (103, []), (104, [0.0] * 24), (105, [float("nan")] + [1.0] * 23), (106, [None] + [1.0] * 23), (107, [float("inf")] * 24), (108, [1.0, 0.0]), (109, [1.0, 0.01]), (110, [1e300] * 24)]
    df = spark.createDataFrame([(i, v, "own") for i, v in data], "vec_id LONG, embedding ARRAY<DOUBLE>, `class` STRING")
    ok = [i for i, (_, v) in enumerate(data) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = {i: np.array(data[i][1]) / np.abs(data[i][1]).max() for i in ok}
    cos = lambda a, b: len(a) == len(b) and float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)) >= 0.9
    links = [(i, j) for i in ok for j in ok if i != j and cos(unit[i], unit[j])]
    part = closure(len(data), links)
    deg = Counter(i for i, _ in links)
    first = {p: min(data[i][0] for i in range(len(data)) if part[i] == p and data[i][0] is not None) for p in set(part)}
    expect = Counter((v, deg[i], first[part[i]], v == first[part[i]]) for i, (v, _) in enumerate(data))
    for block in (1024, 3):
        got = embedding_dedup.near_vectors(df, 0.9, tables=24, block=block)
        assert Counter((x["vec_id"], x["n_links"], x["component_id"], x["kept"]) for x in got.collect()) == expect
        assert "class" in got.columns
    assert embedding_dedup.near_vectors(df.where("false")).count() == 0


def test_recall_of_near_vectors(spark):
    """Recall against brute force at the threshold, on vectors whose cosines spread around it."""
    r = np.random.default_rng(13)
    base = r.standard_normal((150, 64))
    x = np.concatenate([base, *[base + s * r.standard_normal((150, 64)) for s in (0.2, 0.3, 0.4)]])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id LONG, embedding ARRAY<DOUBLE>")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_vectors(df).collect()}
    assert all(got[i] <= near[i].sum() for i in got) and sum(got.values()) >= 0.9 * near.sum()


def test_recall_with_the_keys_of_a_large_table(spark, monkeypatch):
    """Links just above the threshold, found with the parameters of the query and keys as long as for 10 million vectors."""
    r = np.random.default_rng(14)
    base = r.standard_normal((400, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = r.standard_normal((400, 64))
    side -= (side * base).sum(1, keepdims=True) * base
    x = np.concatenate([base, 0.902 * base + math.sqrt(1 - 0.902 ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)])
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    inner = embedding_dedup._links_of_length
    monkeypatch.setattr(embedding_dedup, "_links_of_length", lambda classes, n, *rest: inner(classes, 10_000_000, *rest))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id LONG, embedding ARRAY<DOUBLE>")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_vectors(df).collect()}
    assert all(got[i] <= near[i].sum() for i in got)
    print("recall", sum(got.values()) / near.sum())
    assert sum(got.values()) >= 0.9 * near.sum()


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.Example.COM/en/x?q#f", "http://www.example.com/en/", "https://x.net/es/1", "http://net/fr/", "http://com", "http://com/", "http://xcom/a",
            "http://example.com.evil.org/en/", "a://b.com://c/d", "http://u@example.com:80/en/", "http://bad.org/page?x", "http://bad.org/page/", "http://example.com/en/", "http://example.com/en/"]
    pages = spark.createDataFrame([(i, u, "own", "own") for i, u in enumerate(urls)], "page_id INT, url STRING, rule STRING, best STRING")
    rules = spark.createDataFrame(catalog.URL_RULES + [(None, "/", "block"), ("com", "/", "allow")], "host STRING, path STRING, verdict STRING")
    listed = spark.createDataFrame([("bad.org/page",), (None,)], "u STRING")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, rules, listed).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:n].lower(), rest[n:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
        fits = [(len(h + p), len(h), v, h + p) for h, p, v in catalog.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        expect = (max(fits)[3], max(fits)[2]) if fits else (None, "block" if host + path == "bad.org/page" else "allow")
        assert got[i] == (host, path, *expect), u
    assert url_filter.judge_urls(pages.where("false"), rules).count() == 0
    assert url_filter.judge_urls(pages, rules.where("false")).where("verdict = 'block' or rule is not null").count() == 0


def test_token_counts(docs, none):
    pieces, scores = token_counts.zipf_pieces(catalog.tokenizer_file("piece_bpe_32k.model"))
    got = token_counts.count_pieces(docs, pieces, scores, keep=["doc_id", "text", "score"])
    counter = token_counts.WordCounter(pieces, scores)
    for r in got.collect():
        t = r["text"] or ""
        parts = [counter.word(token_counts.SPACE + p) for p in (t[1:] if t.startswith(" ") else t).split(" ")] if t else []
        assert r["n_tokens"] == sum(n for n, _ in parts) and math.isclose(r["log_score"], sum(s for _, s in parts), abs_tol=1e-6)
    assert token_counts.count_pieces(none, pieces, scores).count() == 0


def test_packing(docs, none):
    path, cap = catalog.tokenizer_file("word_bpe_49k.json"), 64
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    out = packing.pack_documents(docs, path, end_id=1, capacity=cap, pool=10).collect()
    expect = Counter()
    for r in ROWS:
        ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 1]
        expect += Counter((r[0], s, len(ids[s:s + cap]), zlib.crc32(np.array(ids[s:s + cap], "<u4").tobytes()), len(ids)) for s in range(0, len(ids), cap))
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in out) == expect
    for s in {r["sequence_id"] for r in out}:
        at = 0
        for r in sorted((r for r in out if r["sequence_id"] == s), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= cap
    assert packing.pack_documents(none, path, 1).count() == 0


def test_language_model(docs, none):
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2
    kind = lambda r: zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2
    toks = [[*low(r[1]).split(), None] for r in ROWS]
    c = Counter(x for r, t in zip(ROWS, toks) if not kind(r) for x in t)
    n, v = sum(c.values()), len(c)
    for top in (4096, 3):
        got = language_model.score_texts(docs, ~held, keep=["doc_id", "text", "known"], top=top, classes=min(top, 20))
        rows = {(r["doc_id"], r["text"]): r for r in got.collect()}
        for r, t in zip(ROWS, toks):
            g = rows[r[0], r[1]]
            assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (len(t), sum(c[x] > 0 for x in t), n)
            assert math.isclose(g["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), abs_tol=1e-6)
            assert g["score"] < 0 and math.isfinite(g["score"])
    assert language_model.score_texts(none, ~held, keep=["doc_id"]).count() == 0
    untrained = language_model.score_texts(docs, F.lit(False), keep=["doc_id"]).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in untrained)


def test_the_model_is_normalised_and_learns(spark):
    text = " ".join(["a b c d"] * 500)
    df = components.stored(spark.createDataFrame([(i, text) for i in range(8)] + [(9, " ".join(["d c b a"] * 500))], "doc_id LONG, text STRING"), "lm")
    got = {r["doc_id"]: r for r in language_model.score_texts(df, F.col("doc_id") < 8, keep=["doc_id"], rounds=6).collect()}
    assert got[0]["score"] > got[0]["base_score"] * 0.9 and got[0]["score"] > got[9]["score"]
    keys = np.array([5, 9, int(language_model.END)], np.uint64)
    m = language_model.new_model(language_model.Counts(keys, np.array([7, 3, 2]), [12, 4, 0, 0, 2], [4, 2, 0, 0, 1]), 2)
    classes = np.arange(m.n)
    contexts = np.full((language_model.CONTEXT, m.n), m.n)
    assert math.isclose((10 ** m.log10_class(classes, contexts)).sum(), 1, abs_tol=1e-5)


def test_quality(spark, docs, none):
    good = [(i, say(rng.randint(5, 400)), 1) for i in range(160)]
    bad = [(i, " ".join(f"{x.upper()}!!" for x in say(rng.randint(5, 400)).split()), 0) for i in range(160, 240)]
    df = spark.createDataFrame([r[:2] for r in good + bad], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in good + bad] + [(None, 1, 0), (3, None, 0)], "doc_id LONG, quality INT, toxic INT")
    held = catalog.remainder(5) == 0
    model = quality.fit(df, labels, ~held)
    out = quality.score_documents(df, model).withColumn("held", held).where("held").collect()
    assert len(out) > 20 and all((r["score"] >= catalog.PASS_SCORE) == (r["doc_id"] < 160) for r in out)
    scored = quality.score_documents(docs, model).collect()
    assert len(scored) == len(ROWS) and all(0 <= r["score"] <= 1 for r in scored)
    assert len({r["score"] for r in scored if r["text"] == BASE}) == 1
    assert quality.score_documents(none, model).count() == 0
    assert {r["score"] for r in quality.score_documents(docs, quality.fit(docs, labels.where("false"), ~held)).collect()} == {0.5}
    assert {r["score"] for r in quality.score_documents(docs, quality.fit(df, labels.where("quality = 1"), ~held)).collect()} == {1.0}


def test_quality_sample_is_bounded_by_documents(spark, monkeypatch):
    """Repeated label rows, repeated document rows and one id with many texts neither fill the sample nor pass its bound."""
    texts = [(i, say(20) if i % 2 else say(20).upper()) for i in range(20)]
    docs = spark.createDataFrame(texts + [texts[3]] * 50 + [(50, texts[5][1])], "doc_id LONG, text STRING")
    rows = [(i, i % 2) for i, _ in texts] + [(3, 1)] * 50 + [(50, 1)]
    labels = spark.createDataFrame(rows, "doc_id LONG, quality INT")
    bags, inner = [], quality.learn
    monkeypatch.setattr(quality, "learn", lambda x, bounds, labels, **k: bags.append((len(labels), k.get("weights"))) or inner(x, bounds, labels, **k))
    quality.fit(docs, labels, F.lit(True), sample=25)
    assert bags[-1][0] == 20 and sorted(bags[-1][1]) == [1.0] * 19 + [2.0]
    many = spark.createDataFrame([(3, f"{say(5)} t{i}") for i in range(40)], "doc_id LONG, text STRING")
    quality.fit(docs.unionByName(many), labels, F.lit(True), sample=25)
    assert sum(bags[-1][1]) == 25
    many = spark.createDataFrame([(3, f"{say(5)} t{i}") for i in range(2000)], "doc_id LONG, text STRING")
    model = quality.fit(docs.unionByName(many), labels, F.lit(True), sample=25)
    assert bags[-1][0] <= 25 and model.constant is None


def test_weights_stand_for_repeated_bags():
    r = np.random.default_rng(15)
    x, labels = r.standard_normal((8, quality.FEATURES)), np.array([0.0, 1, 0, 1, 1, 0, 1, 0])
    again = np.array([3, 1, 1, 2, 1, 1, 1, 1])
    one = quality.learn(x, np.arange(9), labels, weights=again.astype(float))
    many = quality.learn(np.repeat(x, again, 0), np.arange(again.sum() + 1), np.repeat(labels, again))
    assert np.allclose(one.mean, many.mean) and np.allclose(one.scale, many.scale)
    assert all(np.allclose(one.weights[k], many.weights[k], atol=1e-6) for k in many.weights)


def test_empty_tables(spark, none):
    assert ngram_join.ngram_components(none).count() == 0
    assert substring_dedup.remove_repeated(none).count() == 0
    assert records.token_records(spark, none, catalog.tokenizer_file("byte_bpe_50k.json"), 2).count() == 0
    assert decontaminate.without_benchmark(none, spark.createDataFrame([(1, "a b")], "item_id LONG, text STRING")).count() == 0


def test_components_of_a_chain_a_star_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 130)] + [(200, 200), (None, 3), (7, 6)]
    got = components.components(spark.createDataFrame(links, "x LONG, y LONG")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["component"], set()).add(r["node"])
    assert sorted(map(sorted, groups.values())) == [list(range(61)), list(range(100, 130))]


def test_pipeline_against_brute_force(spark):
    """Each stage of the pipeline on its own input, on the smallest tables."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(components.stored(stage(spark, frames[-1], sf), f"test-{name}"))
    assert all(f.columns == docs.columns for f in frames[:-1])
    rows = [{r["doc_id"]: r for r in f.collect()} for f in frames[:-1]]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all((i in rows[1]) == (labels[i] == 1) for i in labels)
    ids = sorted(rows[1])
    _, part = brute_components([rows[1][i]["text"] for i in ids], corpus_pipeline.NGRAM, corpus_pipeline.SIMILARITY)
    first = {}
    for i, p in zip(ids, part):
        first.setdefault(p, i)
    assert sorted(rows[2]) == sorted(first.values())
    n = corpus_pipeline.PASSAGE_WORDS
    count = Counter(tuple(w[i:i + n]) for w in (words(r["text"]) for r in rows[2].values()) for i in range(len(w) - n + 1))
    for i, r in rows[2].items():
        w = words(r["text"])
        gone = {j for k in range(len(w) - n + 1) if count[tuple(w[k:k + n])] > 1 for j in range(k, k + n)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone).decode() if gone else r["text"]
        assert rows[3][i]["text"] == kept and rows[3][i]["n_chars"] == (len(kept) if gone else r["n_chars"])
    found = {r["doc_id"] for r in decontaminate.find_benchmark(frames[3], spark.read.parquet(f"{sf}/benchmark.parquet")).where("size(spans) > 0").collect()}
    assert set(rows[4]) == set(rows[3]) - found
    pieces = frames[5].collect()
    assert {r["doc_id"] for r in pieces} == set(rows[4])
    assert corpus_pipeline.run(spark, sf).count() == len(pieces)


def test_kept_digest_of_the_query(spark):
    got = catalog.op2_substring_dedup(spark, "/root/testdata/sf0.001").where("n_words = n_removed and n_words > 0").first()
    assert got is None or got["kept_sha256"] == hashlib.sha256(b"").hexdigest()
