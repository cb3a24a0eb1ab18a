"""Long words and runs of words that sums of powers modulo 2**64 cannot tell apart: Thue-Morse words and their complements."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import bytescan, components, decontaminate, language_model, ngram_join, substring_dedup, token_counts


def thue_morse(n, a, b):
    return [b if bin(i).count("1") % 2 else a for i in range(n)]


PAIRS = [("".join(thue_morse(n, "a", "b")), "".join(thue_morse(n, "b", "a"))) for n in (1024, 4096)]
RUNS = [" ".join(thue_morse(2048, "a", "b")), " ".join(thue_morse(2048, "b", "a"))]


def docs(spark, texts):
    return components.stored(spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").coalesce(1), "test-docs")


@pytest.mark.parametrize("n", [64, 1024, 2048, 4096])
def test_hashes_tell_thue_morse_runs_apart(n):
    for kind in (np.uint8, np.uint32, np.uint64):
        x = np.array(thue_morse(n, 97, 98) + thue_morse(n, 98, 97), kind)
        at = np.array([0, n])
        assert len(set(bytescan.hash_spans(x, at, at + n).tolist())) == 2
        assert len(set(bytescan.hash_windows(x, at, n).tolist())) == 2


def test_runs_and_windows_are_named_by_content():
    rng = np.random.default_rng(1)
    for kind in (np.uint8, np.uint64):
        v = rng.integers(0, 3, 400).astype(kind)
        s = rng.integers(0, 360, 3000)
        e = s + rng.integers(0, 40, 3000)
        runs = [tuple(v[i:j].tolist()) for i, j in zip(s, e)]
        h = bytescan.hash_spans(v, s, e).tolist()
        assert len(set(zip(runs, h))) == len(set(runs)) == len(set(h))
        for m in (1, 2, 3, 7, 8, 35):
            at = np.arange(400 - m + 1)
            runs = [tuple(v[i:i + m].tolist()) for i in at]
            h = bytescan.hash_windows(v, at, m).tolist()
            assert len(set(zip(runs, h))) == len(set(runs)) == len(set(h))


@pytest.mark.parametrize("a,b", PAIRS)
def test_five_operators_tell_the_words_apart(spark, a, b):
    table = docs(spark, [a, b, "x " + a, "x " + b])
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(table, 4, 85).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3}

    tail = " ".join(f"w{i}" for i in range(34))
    table = docs(spark, [f"{a} {tail}", f"{b} {tail}", f"{a} {tail} end"])
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeated(table, 35).collect()}
    assert got == {0: 35, 1: 0, 2: 35}

    items = spark.createDataFrame([("i", a)], "item_id STRING, text STRING")
    got = {r["doc_id"]: list(r["items"]) for r in decontaminate.find_benchmark(docs(spark, [a, b, f"{b} {a}"]), items).collect()}
    assert got == {0: ["i"], 1: [], 2: ["i"]}

    scored = docs(spark, [f"{a} z", f"{a} {b}"]).withColumn("held_out", F.col("doc_id") == 1)
    got = {r["doc_id"]: (r["n_tokens"], r["n_known"]) for r in language_model.score_texts(scored, training=~F.col("held_out"), keep=["doc_id"]).collect()}
    assert got == {0: (3, 3), 1: (3, 2)}

    pieces, scores = ["▁", "a", "b", "ab", "ba", "▁a", "▁b"], [-1.0, -2.0, -3.0, -1.5, -4.0, -0.5, -0.9]
    alone = [token_counts.WordCounter(pieces, scores).word("▁" + w) for w in (a, b)]
    counts, values = token_counts.WordCounter(pieces, scores).count(pa.array([a, b]))
    assert counts.tolist() == [n for n, _ in alone] and np.allclose(values, [s for _, s in alone], rtol=1e-12, atol=0)
    assert abs(alone[0][1] - alone[1][1]) > 0.1


def test_long_runs_of_words(spark):
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeated(docs(spark, RUNS), 2048).collect()}
    assert got == {0: 0, 1: 0}
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(docs(spark, RUNS), 2048, 85).collect()}
    assert got == {0: 0, 1: 1}
