"""Keys that stand in very many documents: bounded groups, and the same results whatever counts as hot."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import components, exchange, language_model, ngram_join, substring_dedup

rng = random.Random(12)
VOCABULARY = [f"w{i}" for i in range(40)]
PASSAGE = " ".join(f"p{i}" for i in range(40))
TEXTS = ["common " + " ".join(rng.choices(VOCABULARY, k=rng.randint(0, 60))) + (" " + PASSAGE if i % 3 == 0 else "") for i in range(240)] + ["common"] * 30 + [None, ""]


@pytest.fixture(scope="module")
def docs(spark):
    df = components.stored(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id LONG, text STRING").repartition(12), "test-docs")
    return df.withColumn("held_out", F.col("doc_id") % 7 == 2)


@pytest.fixture(params=[2, 5, 256])
def small_batches(request, spark, monkeypatch):
    """Batches of 16 rows; keys of so many documents of one are hot."""
    monkeypatch.setattr(exchange, "HOT", request.param)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    yield request.param
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_key_has_a_bounded_number_of_pairs_in_its_bucket():
    for total in (1, 10 ** 9, 10 ** 12, 10 ** 13):
        batches = 1 + total // exchange.BATCH_BYTES
        hot = exchange.hot_limit(total, 0)
        assert 2 <= hot <= exchange.HOT and (hot == 2 or hot * batches <= exchange.KEY_PAIRS)
    assert exchange.hot_limit(10 ** 9, 10 ** 3) == exchange.HOT and exchange.hot_limit(0, 10 ** 10) == 2


def test_a_word_in_every_text_of_many_small_batches_passes_no_bound(monkeypatch):
    monkeypatch.setattr(exchange, "KEY_PAIRS", 1000)
    batches, texts = 200, 50
    hot = exchange.hot_limit(0, batches * exchange.BATCH_ROWS)
    key = np.uint64(12345)
    tables = [pa.Table.from_batches([exchange.pack(b, np.full(texts, key), np.arange(texts), np.full(texts, 3, "<u4"), b"", 4, hot,
                                                   lambda extra, first: np.add.reduceat(extra, first))]) for b in range(batches)]
    rows = pa.concat_tables(tables).to_pylist()
    by_bucket = Counter()
    for r in rows:
        by_bucket[r["bucket"] if not r["hot"] else ("own", r["batch"])] += len(r["numbers"]) // 2
    assert max(by_bucket.values()) <= 1000 and sum(n for b, n in by_bucket.items() if not isinstance(b, int)) == batches * texts
    marks = [np.frombuffer(r["extra"], "<u4") for r in rows if not r["hot"] and r["extra"]]
    assert sum(int(m.sum()) for m in marks) == 3 * batches * texts


def test_language_model_counts_do_not_hang_on_what_is_hot(docs, small_batches):
    got = {r["doc_id"]: r for r in language_model.score_texts(docs, training=~F.col("held_out"), keep=["doc_id"], top=3, classes=2).collect()}
    words = {i: (t or "").split() for i, t in enumerate(TEXTS)}
    counts = Counter(w for i, ws in words.items() if i % 7 != 2 for w in [*ws, "\n"])
    n, v = sum(counts.values()), len(counts)
    for i, ws in words.items():
        r, tokens = got[i], [*ws, "\n"]
        assert (r["n_tokens"], r["train_tokens"], r["n_known"]) == (len(tokens), n, sum(counts[t] > 0 for t in tokens))
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), abs=1e-9)


def test_components_do_not_hang_on_what_is_hot(docs, small_batches):
    sets = [set(zip(*((t or "").split()[j:] for j in range(2)))) or ({tuple((t or "").split())} if (t or "").split() else set()) for t in TEXTS]
    part = list(range(len(sets)))

    def find(i):
        while part[i] != i:
            i = part[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 40 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                part[y] = x
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(docs.select("doc_id", "text"), 2, 40).collect()}
    assert got == {i: find(i) for i in range(len(sets))}


def test_repeated_windows_do_not_hang_on_what_is_hot(docs, small_batches):
    size, words = 12, [(t or "").split() for t in TEXTS]
    seen = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    expect = {}
    for k, w in enumerate(words):
        gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i:i + size])] > 1 for j in range(i, i + size)}
        expect[k] = (len(w), len(gone))
    for hot_words in (100, 40_000):
        got = substring_dedup.remove_repeated(docs.select("doc_id", "text"), size, hot_words=hot_words)
        assert {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in got.collect()} == expect
