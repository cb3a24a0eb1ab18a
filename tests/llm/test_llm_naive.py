"""Models against plain loops, texts longer than a slice, and pipeline stages on edge cases."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestar.llm import bytescan, components, decontaminate, language_model, ngram_join, quality, secret_scan, substring_dedup

rng = random.Random(21)
SF = "/root/testdata/sf0.001"


def stored(spark, rows, schema):
    return components.stored(spark.createDataFrame(rows, schema), "test-docs")


def test_attention_score_is_the_plain_forward_pass():
    """Every passage by itself: hidden layer, gate, softmax over the document, weighted sum, logistic."""
    texts = ["", "one two", "WORD " * 200, " ".join(rng.choices(["the", "a.", "Cat!", "12", "éa", "||"], k=500)), "x" * 5000]
    (_, _, data, offsets), = bytescan.text_slices(pa.array(texts))
    x, bounds = quality.passages(data, offsets)
    model = quality.learn(x, bounds, np.array([1.0, 0.0, 0.0, 1.0, 0.0]), steps=25)
    w = model.weights
    for i in range(len(texts)):
        hidden, pull = [], []
        for row in x[bounds[i]:bounds[i + 1]]:
            v = [min(6.0, max(-6.0, (float(a) - float(m)) / float(s))) for a, m, s in zip(row, model.mean, model.scale)]
            h = [math.tanh(sum(v[j] * w["W"][j, k] for j in range(len(v))) + w["a"][k]) for k in range(quality.HIDDEN)]
            gate = 0.0
            for g in range(quality.GATE):
                t = math.tanh(sum(h[k] * w["V"][k, g] for k in range(quality.HIDDEN)))
                u = 1 / (1 + math.exp(-sum(h[k] * w["U"][k, g] for k in range(quality.HIDDEN))))
                gate += t * u * w["w"][g]
            hidden.append(h)
            pull.append(math.exp(gate))
        z = [sum(p * h[k] for p, h in zip(pull, hidden)) / sum(pull) for k in range(quality.HIDDEN)]
        score = 1 / (1 + math.exp(-(sum(a * b for a, b in zip(z, w["c"])) + w["d"][0])))
        assert model.score(x, bounds)[i] == pytest.approx(score, abs=1e-5)


def test_language_model_score_is_the_sum_of_plain_log_probabilities(spark, monkeypatch):
    texts = [" ".join(rng.choices(["a", "b", "cd", "é", "x.", "y1", "Rare", f"only{i}"], [9, 7, 5, 3, 3, 2, 1, 1], k=rng.randint(0, 40))) for i in range(60)] + [None, "unseen wörd ..."]
    docs = stored(spark, list(enumerate(texts)), "doc_id LONG, text STRING").withColumn("held_out", F.col("doc_id") % 5 == 1)
    models = []
    real = language_model.train
    monkeypatch.setattr(language_model, "train", lambda *args: models.append(real(*args)) or models[0])
    got = {r["doc_id"]: r["score"] for r in language_model.score_texts(docs, training=~F.col("held_out"), keep=["doc_id"], top=6, classes=4).collect()}
    m = models[0]
    keys = {i: next(language_model.tokens(pa.array([t])))[2] if t else np.array([language_model.END]) for i, t in enumerate(texts)}
    counts = Counter(k for i, ks in keys.items() if i % 5 != 1 for k in ks.tolist())
    class_of = lambda k: int(m.classes(np.array([k], np.uint64))[0])
    rare_n, rare_v = Counter(), Counter()
    for k, n in counts.items():
        rare_n[class_of(k)] += n
        rare_v[class_of(k)] += 1
    for i, ks in keys.items():
        total, before = 0.0, [m.n] * language_model.CONTEXT
        for k in ks.tolist():
            p = sum(m.c[j].astype(float) * m.r[before[j]] for j in range(language_model.CONTEXT))
            logits = np.array([float(p @ m.q[c]) + float(m.b[c]) for c in range(m.n)])
            c = class_of(k)
            total += (logits[c] - math.log(np.exp(logits).sum())) / math.log(10)
            if c >= m.single:
                total += math.log10((counts[k] + 1) / (rare_n[c] + rare_v[c] + 1))
            before = [c, *before[:-1]]
        assert got[i] == pytest.approx(total, abs=1e-3), i


@pytest.fixture(scope="module")
def long_text():
    words = [f"w{rng.randrange(10 ** 7)}" for _ in range(330_000)]
    words[100_000:100_060] = words[300_000:300_060]
    words[200_000] = "token=" + "".join(rng.choices("0123456789abcdef", k=40))
    text = " ".join(words)
    assert len(text) > bytescan.SLICE_BYTES
    return text


def test_texts_longer_than_a_slice_stay_whole(spark, long_text):
    words = long_text.split()
    near = " ".join(["changed", *words[1:]])
    docs = stored(spark, [(1, long_text), (2, "short text of few words"), (3, near), (4, None)], "doc_id LONG, text STRING")
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(docs, 4, 85).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}
    one = docs.where("doc_id <> 3")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.remove_repeated(one, 35).collect()}
    assert got == {1: (len(words), 120), 2: (5, 0), 4: (0, 0)}
    bench = spark.createDataFrame([("x", " ".join(words[299_990:300_010]))], "item_id STRING, text STRING")
    found = {r["doc_id"]: r for r in decontaminate.find_benchmark(one, bench).collect()}  # "=" ends a word here, so later words count one more
    assert [tuple(s) for s in found[1]["spans"]] == [(100_000, 100_010), (299_991, 300_011)] and found[2]["items"] == []
    place = long_text.index("token=")
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.find_secrets(one).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in spans[1]] == [("assign", place, place + 46), ("hex", place + 6, place + 46)] and spans[2] == []


CLASHING = ("row", "score", "n_words", "n_removed", "kept", "spans", "items", "component", "component_id", "key", "hash", "one", "text_hash", "batch")


def documents(spark, rows):
    df = stored(spark, rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    for c in CLASHING:
        df = df.withColumn(c, F.lit("own"))
    return df


def test_pipeline_stages_on_edge_cases(spark):
    say = lambda n: " ".join(rng.choices([f"v{i}" for i in range(500)], k=n))
    passage, base = say(60), say(200)
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, base, "en", "s", 1), (3, base, "en", "s", 1), (4, base + " more", "de", "s", 2), (5, "a " + passage + " " + say(30), "fr", None, 9),
            (6, say(20) + " " + passage, "en", "s", 7), (None, say(15), "en", "s", 3), (None, None, None, None, None), (7, " \n", "en", "s", 2)]
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs.where("false"), SF)
        assert none.count() == 0, name
        if name != "packing":
            assert none.columns == docs.columns, name
    kept = corpus_pipeline.keep_one_of_each(spark, docs, SF)
    assert kept.columns == docs.columns and kept.where("score = 'own'").count() == kept.count()
    # One of the base text's copies and near copies; every row without words stays.
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, 5, 6, 7, None, None])
    cut = {(r["doc_id"], r["lang"]): r for r in corpus_pipeline.cut_repeated(spark, docs.where("doc_id <> 3 and doc_id <> 4 or doc_id is null"), SF).collect()}
    assert cut[5, "fr"]["text"].split() == ["a", *rows[5][1].split()[61:]] and cut[5, "fr"]["n_chars"] == len(cut[5, "fr"]["text"])
    assert cut[6, "en"]["text"] == " ".join(rows[6][1].split()[:20]) and cut[1, None]["text"] is None and cut[7, "en"]["text"] == " \n" and cut[2, "en"]["n_chars"] == 0
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null").first()["text"]
    with_item = docs.unionByName(documents(spark, [(50, "before " + item + " after", "en", "s", 1)]))
    clean = corpus_pipeline.drop_benchmark(spark, components.stored(with_item, "test-docs"), SF)
    assert clean.columns == docs.columns and Counter(r["doc_id"] for r in clean.collect()) == Counter(r[0] for r in rows)
    pieces = corpus_pipeline.pack(spark, docs, SF).collect()
    assert sum(r["length"] for r in pieces) == sum(r["doc_tokens"] for r in pieces if r["start"] == 0) and sum(r["start"] == 0 for r in pieces) == len(rows)
    good = corpus_pipeline.keep_good(spark, docs, SF)  # rows of these ids are labelled in the table
    assert good.columns == docs.columns and good.count() <= len(rows)


