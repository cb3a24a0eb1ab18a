"""op9: every word of training has a vector, not only the most frequent ones."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import components, exchange, language_model as lm


def stored(spark, texts):
    return components.stored(spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING"), "every-word")


def test_words_beyond_the_classes_hang_on_their_context(spark, monkeypatch):
    """Hundreds of words below the most frequent ones: each is likelier after the word it follows in training than after another."""
    monkeypatch.setattr(lm, "CLASSES", 20)
    rng = random.Random(2)
    pairs = [(f"key{i}", f"value{i}") for i in range(300)]
    texts = [" ".join(x for _ in range(60) for x in ("f" + str(rng.randrange(20)), *rng.choice(pairs))) for _ in range(400)]
    some = rng.sample(pairs, 60)
    right, wrong = [" ".join(p) for p in some], [f"{a} {some[i - 1][1]}" for i, (a, _) in enumerate(some)]
    df = stored(spark, texts + right + wrong)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")   # many batches, as of a large table
    try:
        got = {r["doc_id"]: r for r in lm.score_texts(df, F.col("doc_id") < 400, keep=["doc_id"], rate=0.3).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    gain = [got[400 + i]["score"] - got[460 + i]["score"] for i in range(60)]
    assert np.mean(gain) > 0.1 and np.mean(np.array(gain) > 0) > 0.6  # with four classes for all of them the mean is 0
    # One word less or more in the classes makes no difference to the counts.
    c = Counter(w for t in texts for w in [*t.split(), None])
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(right):
        assert got[400 + i]["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*t.split(), None]), abs=1e-6)
        assert got[400 + i]["n_known"] == 3


def test_a_leaf_adds_up_to_its_share_and_learns():
    rng = np.random.default_rng(1)
    keys = np.concatenate([np.sort(rng.integers(0, 1 << 61, n).astype(np.uint64)) | np.uint64(k << 62) for k, n in ((0, 37), (2, 5), (3, 16))])
    counts = rng.integers(1, 30, len(keys))
    leaves = lm.Leaves(np.concatenate([keys, keys]), np.concatenate([counts, counts]))
    assert leaves.count.tolist() == (2 * counts).tolist() and len(set(leaves.place.tolist())) == len(keys)
    leaf = leaves.place // lm.LEAF
    assert all(len({int(lm.rare_class(keys[leaf == x])[i]) for i in range((leaf == x).sum())}) == 1 for x in set(leaf.tolist()))
    leaves.q[:] = rng.standard_normal(leaves.q.shape)
    p = rng.standard_normal((1, lm.WIDTH)).astype(np.float32)
    gain = 10 ** leaves.log10_in_leaf(leaves.place, np.repeat(p, len(keys), 0))
    for x in set(leaf.tolist()):
        s = leaves.count[leaf == x] + 1
        assert (gain[leaf == x] * s).sum() == pytest.approx(s.sum(), rel=1e-5)
    # Words of one leaf in two contexts.
    leaves.q[:], mine = 0, leaves.place[:4]
    a, b = p, -p
    for _ in range(200):
        leaves.train_step(np.tile(mine, 8), np.tile(np.concatenate([a, a, b, b]), (8, 1)), np.ones(32, np.float32), rng, 0.05)
    gain = leaves.log10_in_leaf(mine, np.concatenate([a, a, b, b])) - leaves.log10_in_leaf(mine, np.concatenate([b, b, a, a]))
    assert (gain > 0.3).all()
    empty = lm.Leaves(np.zeros(0, np.uint64), np.zeros(0))
    assert not empty.find(keys)[0].any() and len(empty.log10_in_leaf(np.zeros(0, np.int64), np.zeros((0, lm.WIDTH), np.float32))) == 0


@pytest.mark.parametrize("max_docs, max_pairs", [(20_000, 1_000_000), (3, 1_000_000), (20_000, 25)])
def test_every_token_outside_the_head_is_dealt_once(monkeypatch, max_docs, max_pairs):
    monkeypatch.setattr(exchange, "MAX_DOCS", max_docs)
    monkeypatch.setattr(exchange, "MAX_PAIRS", max_pairs)
    monkeypatch.setattr(lm.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 1})()))
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["a", "b", *[f"w{i}" for i in range(50)]], k=rng.randrange(30))) for _ in range(40)] + [""] * 3
    texts += texts[:5]
    train = [i % 3 > 0 for i in range(len(texts))]
    names = {t: i for i, t in enumerate(dict.fromkeys(texts))}
    key = {w: int(next(lm.tokens(pa.array([w])))[2][0]) for w in ["a", "b", *[f"w{i}" for i in range(50)]]}
    head = np.sort(np.array([key["a"], key["b"], int(lm.END)], np.uint64))
    m = lm.new_model(lm.Counts(head, np.array([9, 9, 9]), [50, 50, 50, 50, 9], [30, 30, 30, 30, 1]), 3, hashed=7)
    batch = pa.RecordBatch.from_arrays([pa.array([names[t] for t in texts], pa.int64()), pa.array(train), pa.array(texts)], names=["text", "train", "body"])
    got, docs = Counter(), []
    rows = [r for b in lm._tokens_dealt(iter([batch]), type("B", (), {"value": m}), 4) for r in b.to_pylist()]
    at = {r["batch"]: np.frombuffer(r["docs"], lm._DOC)["text"].tolist() for r in rows if r["docs"] is not None}
    docs = [x for d in at.values() for x in d]
    assert sorted(docs) == sorted(names.values()) and max(map(len, at.values())) <= max_docs
    for r in rows:
        extra = np.ascontiguousarray(np.frombuffer(r["extra"], np.uint8).reshape(lm._TOKEN.itemsize, -1).T).view(lm._TOKEN).reshape(-1)
        for k, n, e in zip(exchange.from_planes(r["keys"]).tolist(), np.frombuffer(r["numbers"], "<u2").tolist(), extra.tolist()):
            got[k, at[r["batch"]][n], e[0], tuple(e[1])] += 1
    expect = Counter()
    place = {w: int(m.decoded(m.codes(np.array([k], np.uint64), m.classes(np.array([k], np.uint64))))[1][0]) for w, k in key.items()}
    for t, i in names.items():
        words = t.split()
        for j, w in enumerate(words):
            if w not in "ab":
                before = tuple(place[words[j - x]] if j >= x else m.n for x in range(1, lm.CONTEXT + 1))
                expect[key[w], i, sum(tr for u, tr in zip(texts, train) if u == t), before] += 1
    assert got == expect and len({place[f"w{i}"] for i in range(50)}) > 4
