"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Tokens are lower-cased (A-Z) words and one end per text.  The model predicts the
*class* of each token from the classes of the ``CONTEXT`` tokens before it: the
most frequent tokens are classes of their own, all other words fall into four
*rare* classes (whether the word has a byte outside ASCII, and whether its last
byte is a letter or digit or outside ASCII).  A context is the sum of its
tokens' vectors, each times a vector of its position; a class has the score of
its own vector with it plus a bias.  Scores are normalised over all classes by a
matrix product, and a rare word has its add-one share of its class (with one share
for all unseen words), so the log-probabilities are those of a proper model.

Counting.  Batches of training texts send their distinct words with counts;
this gives the totals and the ``TOP`` most frequent words, whose counts are
broadcast.  All other (text, word) pairs are dealt by word, packed
(``exchange``); a bucket counts its words over the training texts and answers
every text with the sum of ``tf * log10(count + 1)`` of its words and with how
many are known.  No word dealt this way has more than ``1 / TOP`` of all tokens, and what many texts of a
batch share stays with the batch, which the word's bucket tells the count.
Only the frequent words, the totals and the model come to the driver, all of a
size set by parameters.

Coding.  Every text is written once as the classes of its tokens; training and
scoring read these.

Every word has a vector.  The most frequent ones are classes of the *head*, the model above.  All other words of training, however many,
are dealt by word to buckets (``exchange``), and within a bucket to *leaves* of ``LEAF`` words of one rare class.  The leaf of a word has its add-one share
of the class; in it the word competes with the others by its own vector:

    P(word | class, context) = share(word) exp(p q(word)) / sum over the leaf of share(v) / share(leaf) exp(p q(v)),

``p`` being the context's vector.  A class's probabilities so add up to one whatever the vectors are; a word that training has not seen has its
share alone.  After the head is trained, each token of these words goes once to its word's bucket with its context; the vectors are trained there as the
tokens stream by (noise-contrastive, the noise being words of the leaf), the tokens are put aside in a file, and then scored.  So
a task keeps the words of a bucket and one block of tokens, however common a word is, and the vectors grow with the
corpus without ever being in one place.  As context, a word outside the head has one of ``HASHED`` vectors of its rare class, by a hash.
With ``classes`` given, only so many words have vectors, and all others their shares.

Training.  Every round, each partition starts from the same parameters and
follows noise-contrastive gradients over all tokens of its training texts: the
token against noise classes drawn from the class frequencies and shared by a
minibatch, so that both sides are matrix products.  Parameters are averaged by
token counts after each round.

Defined results: a null or empty text is the end token alone; repeated rows
count as often as they are there; without training texts all counts are 0 and the
model is uniform over its classes; rows with equal ids stay apart; columns named
like a result are replaced.  Documents must be read from stored files (see
``exchange``).
"""

from __future__ import annotations

import math
import pickle
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm import exchange
from lodestar.llm.bytescan import NOT_SPACE, find_words, hash_spans, lower_ascii, sums_by_run, text_slices
from lodestar.llm.components import stored

TOP = 4096          # most frequent words, whose counts are broadcast
CLASSES = 250       # of them, those with a class of their own
CONTEXT = 3
WIDTH = 16
NOISE = 64
BATCH = 4096
SCORED_AT_ONCE = 512
CODED_SLICE = 1 << 20
ROUNDS = 2
RATE = 0.05
LEAF = 16           # words that compete with each other outside the head
LEAF_NOISE = 2
LEAF_BATCH = 4096
HASHED = 1024       # context vectors of the other words of a rare class
END = np.uint64(1 << 61)  # the end token; no word has this hash's two high bits and this value
RARE = 4


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """62 bits of each word's hash below the two bits of its rare class."""
    h = hash_spans(data, starts, ends) >> np.uint64(2)
    if not len(h):
        return h
    wide = np.concatenate([[0], np.cumsum(data >= 0x80)])
    last = data[ends - 1]
    plain = ((last >= 97) & (last <= 122)) | ((last >= 48) & (last <= 57)) | (last >= 0x80)
    kind = (wide[ends] > wide[starts]).astype(np.uint64) * np.uint64(2) + plain
    return h | (kind << np.uint64(62))


def rare_class(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(62)).astype(np.int64)


def tokens(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts ``(first, end, keys, bounds)``: the tokens of all texts with their ends, and where each text's begin."""
    for lo, hi, data, offsets in text_slices(column):
        starts, ends, first = find_words(data := lower_ascii(data), offsets, NOT_SPACE)
        n = np.diff(first) + 1
        bounds = np.concatenate([[0], np.cumsum(n)])
        keys = np.full(int(n.sum()), END)
        keep = np.ones(len(keys), bool)
        keep[bounds[1:] - 1] = False
        keys[keep] = word_keys(data, starts, ends)
        yield lo, hi, keys, bounds


# ---- counting -------------------------------------------------------------------------------------------------------

_PAIR = np.dtype([("tf", "<u4"), ("train", "<u4")])
_DOC = np.dtype([("text", "<i8")])


def _uniques(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct tokens of each batch of training texts with their counts, by bucket."""
    for batch in batches:
        parts = [np.zeros(0, np.uint64)] + [keys for _, _, keys, _ in tokens(batch.column(0))]
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        bounds = np.searchsorted(exchange.bucket_of(keys, buckets), np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(bounds)).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([exchange.to_planes(keys[bounds[b]:bounds[b + 1]]) for b in used], pa.binary()),
             pa.array([counts[bounds[b]:bounds[b + 1]].astype("<u4").tobytes() for b in used], pa.binary())], names=["bucket", "keys", "counts"])


def _most(keys: np.ndarray, counts: np.ndarray, top: int) -> tuple[bytes, bytes]:
    best = np.lexsort((keys, -counts))[:top]
    return keys[best].tobytes(), counts[best].tobytes()


def _totals(table: pa.Table, top: int) -> pa.Table:
    """One row for one bucket: its most frequent words, and by kind (rare class, or the end) its tokens and distinct words."""
    keys = np.concatenate([exchange.from_planes(x) for x in table["keys"].to_pylist()])
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in table["counts"].to_pylist()]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    keys, counts = keys[first], np.add.reduceat(counts, first)
    kinds = np.where(keys == END, RARE, rare_class(keys))
    words = kinds != RARE
    best = _most(keys[words], counts[words], top)
    n, v = ([int(x[kinds == k].sum()) for k in range(RARE + 1)] for x in (counts, np.ones(len(keys), np.int64)))
    return pa.table([pa.array([best[0]], pa.binary()), pa.array([best[1]], pa.binary()), pa.array([n], pa.list_(pa.int64())), pa.array([v], pa.list_(pa.int64()))],
                    names=["keys", "counts", "n", "v"])


def _merge_totals(table: pa.Table, top: int) -> pa.Table:
    """One row for several buckets."""
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()])
    best = _most(keys, np.concatenate([np.frombuffer(x, np.int64) for x in table["counts"].to_pylist()]), top)
    n, v = (np.array(table[c].to_pylist()).sum(0).tolist() for c in ("n", "v"))
    return pa.table([pa.array([best[0]], pa.binary()), pa.array([best[1]], pa.binary()), pa.array([n], pa.list_(pa.int64())), pa.array([v], pa.list_(pa.int64()))],
                    names=["keys", "counts", "n", "v"])


@dataclass
class Counts:
    """What the corpus says: the most frequent tokens, and tokens and distinct words by rare class and for the end."""

    keys: np.ndarray       # ascending; the end is always one of them
    counts: np.ndarray
    n: list[int]
    v: list[int]

    @property
    def kinds(self) -> np.ndarray:
        return np.where(self.keys == END, RARE, rare_class(self.keys))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are frequent, and their places."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, at


_TOTALS = "keys binary, counts binary, n array<long>, v array<long>"


def distinct_words(texts: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, keys, counts)``: :func:`_uniques` of the training texts."""
    return texts.where("train").select("body").mapInArrow(lambda it: _uniques(it, buckets), "bucket int, keys binary, counts binary")


def count_tokens(texts: DataFrame, top: int, words: DataFrame | None = None) -> Counts:
    """``words``: the stored :func:`distinct_words`, if there are."""
    if words is None:
        words = distinct_words(texts, exchange.dealing(texts.where("train"), "body", bytes_per_byte=0.4)[0])
    totals = words \
        .groupBy("bucket").applyInArrow(lambda t: _totals(t, top), _TOTALS) \
        .withColumn("g", F.pmod(F.xxhash64("keys"), F.lit(16))).groupBy("g").applyInArrow(lambda t: _merge_totals(t, top), _TOTALS)
    rows = totals.collect()  # 16 rows at most
    n, v = ([sum(r[c][k] for r in rows) for k in range(RARE + 1)] for c in ("n", "v"))
    keys, counts = _most(np.frombuffer(b"".join(r["keys"] for r in rows), np.uint64), np.frombuffer(b"".join(r["counts"] for r in rows), np.int64), top)
    keys, counts = np.append(np.frombuffer(keys, np.uint64), END), np.append(np.frombuffer(counts, np.int64), n[RARE])
    order = np.argsort(keys)
    return Counts(keys[order], counts[order], n, v)


def _summed(extra: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of all pairs of each word, their occurrences in training."""
    out = extra[first]
    out["train"] = np.add.reduceat(extra["train"].astype(np.int64), first)
    return out


def _pairs(batches: Iterator[pa.RecordBatch], shared, buckets: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Distinct less frequent words of each distinct text of a batch, and how often they occur: in one copy, and in all training copies."""
    serial = TaskContext.get().partitionId() << 32
    known = shared.value
    for batch in batches:
        if not batch.num_rows:
            continue
        names, first, which = np.unique(batch.column(0).to_numpy(), return_index=True, return_inverse=True)
        training = np.bincount(which, batch.column(1).to_numpy(zero_copy_only=False).astype(float), len(names)).astype(np.int64)
        held: list[tuple] = []
        pairs, begin = 0, 0
        for lo, hi, keys, bounds in tokens(batch.column(2).take(pa.array(first))):
            keep = ~known.find(keys)[0]
            bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
            keys = keys[keep]
            for i in range(hi - lo):
                k = np.sort(keys[bounds[i]:bounds[i + 1]])
                new = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
                extra = np.zeros(len(new), _PAIR)
                extra["tf"] = np.diff(np.append(new, len(k)))
                extra["train"] = extra["tf"] * training[lo + i]
                held.append((k[new], np.full(len(new), lo + i - begin), extra))
                pairs += len(new)
                end = lo + i + 1
                if pairs >= exchange.MAX_PAIRS or end - begin >= exchange.MAX_DOCS or end == len(names):
                    docs = np.zeros(end - begin, _DOC)
                    docs["text"] = names[begin:end]
                    yield exchange.pack(serial, *(np.concatenate(x) for x in zip(*held)), docs.tobytes(), buckets, hot, _summed)
                    serial += 1
                    held, pairs, begin = [], 0, end


_ANSWER = "batch long, sums binary, known binary, docs binary, keys binary, numbers binary, values binary"


def _answer(table: pa.Table) -> pa.Table:
    """One bucket: for each batch the sums of ``tf * log10(count + 1)`` and the known tokens of its texts, and the counts of
    words that are marked in it; or for a batch's own words, these as they are."""
    batches, docs = table["batch"].to_pylist(), table["docs"].to_pylist()
    keys, numbers, row, extra = exchange.unpack(table, _PAIR)
    edges = np.searchsorted(row, np.arange(len(batches) + 1))  # rows come one after the other
    out = []
    if table["hot"][0].as_py():
        for i, batch in enumerate(batches):
            s = slice(edges[i], edges[i + 1])
            out.append((batch, None, None, None, keys[s].tobytes(), numbers[s].tobytes(), extra["tf"][s].astype("<u4").tobytes()))
    else:
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(keys), bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        first = np.flatnonzero(new)
        count = np.zeros(len(keys), np.int64)
        if len(keys):
            count[order] = np.repeat(np.add.reduceat(extra["train"][order].astype(np.int64), first), np.diff(np.append(first, len(keys))))
        for i, batch in enumerate(batches):
            s = slice(edges[i], edges[i + 1])
            mine = numbers[s] != exchange.MARK
            tf, c, n = extra["tf"][s][mine], count[s][mine], numbers[s][mine]
            marked, counts = (keys[s][~mine].tobytes(), count[s][~mine].tobytes()) if not mine.all() else (None, None)
            out.append((batch, np.bincount(n, tf * np.log10(c + 1.0)).astype(np.float64).tobytes(),
                        np.bincount(n, tf * (c > 0)).astype(np.float64).tobytes(), docs[i], marked, None, counts))
    cols = list(zip(*out))
    return pa.table([pa.array(cols[0], pa.int64()), *[pa.array(x, pa.binary()) for x in cols[1:]]], names=["batch", "sums", "known", "docs", "keys", "numbers", "values"])


def _gather(table: pa.Table) -> pa.Table:
    """One batch: the sums over all buckets for each of its texts, and over its own words with the counts that their buckets gave."""
    rows = table.to_pylist()
    docs = np.frombuffer(b"".join(r["docs"] for r in rows if r["docs"] is not None), _DOC)
    sums, known = np.zeros(len(docs)), np.zeros(len(docs))
    for r in rows:
        if r["sums"] is not None:
            s, k = np.frombuffer(r["sums"]), np.frombuffer(r["known"])
            sums[:len(s)] += s
            known[:len(k)] += k
    own = [r for r in rows if r["numbers"] is not None]
    if own:
        joined = lambda some, c, kind: np.frombuffer(b"".join(r[c] for r in some), kind)
        told = [r for r in rows if r["keys"] is not None and r["numbers"] is None]
        words, counts = joined(told, "keys", "<u8"), joined(told, "values", "<i8")
        order = np.argsort(words)
        numbers, tf = joined(own, "numbers", "<u2"), joined(own, "values", "<u4").astype(np.float64)
        c = counts[order][np.searchsorted(words[order], joined(own, "keys", "<u8"))]
        sums += np.bincount(numbers, tf * np.log10(c + 1.0), len(docs))
        known += np.bincount(numbers, tf * (c > 0), len(docs))
    return pa.table([pa.array(docs["text"].astype(np.int64)), pa.array(sums), pa.array(known.astype(np.int64))], names=["text", "log_counts", "known"])


def log_counts(texts: DataFrame, counts: Counts) -> DataFrame:
    """``(text, log_counts, known)`` over the words of each text that are not among the most frequent."""
    shared = texts.sparkSession.sparkContext.broadcast(counts)
    buckets, hot = exchange.dealing(texts, "body", bytes_per_byte=1.2)
    answers = texts.mapInArrow(lambda it: _pairs(it, shared, buckets, hot), exchange.SCHEMA) \
        .groupBy("bucket").applyInArrow(_answer, _ANSWER) \
        .groupBy("batch").applyInArrow(_gather, "text long, log_counts double, known long")
    return answers.groupBy("text").agg(F.first("log_counts").alias("log_counts"), F.first("known").alias("known"))


# ---- the model ------------------------------------------------------------------------------------------------------

@dataclass
class Model:
    counts: Counts
    slot: np.ndarray       # class of each of ``counts.keys``; the classes of single tokens come first, then the rare ones
    single: int
    freq: np.ndarray       # training frequency of each class
    r: np.ndarray          # context vectors (classes and start, width)
    c: np.ndarray          # position vectors (context, width)
    q: np.ndarray          # class vectors (classes, width)
    b: np.ndarray          # biases
    hashed: int = 0        # context vectors of each rare class behind those of classes and start, for its words by hash

    @property
    def n(self) -> int:
        return self.single + RARE

    def classes(self, keys: np.ndarray) -> np.ndarray:
        found, at = self.counts.find(keys)
        return np.where(found, self.slot[at], self.single + rare_class(keys))

    def codes(self, keys: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """What is kept of tokens: their classes, or for those of rare ones with hashed context vectors class and vector in one."""
        if not self.hashed:
            return classes
        return np.where(classes < self.single, classes, self.single + (classes - self.single) * self.hashed + (keys & np.uint64(0xFFFFFF)).astype(np.int64) % self.hashed)

    def decoded(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The classes of tokens, and their places among the context vectors."""
        if not self.hashed:
            return codes, codes
        rare = codes >= self.single
        return np.where(rare, self.single + (codes - self.single) // self.hashed, codes), np.where(rare, self.n + 1 + codes - self.single, codes)

    def contexts(self, classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The classes (or places among the context vectors) of the tokens before each token (the start class before a text), a row for each place."""
        place = np.arange(len(classes)) - np.repeat(bounds[:-1], np.diff(bounds))
        out = np.full((CONTEXT, len(classes)), self.n)
        for j in range(CONTEXT):
            has = np.flatnonzero(place > j)
            out[j, has] = classes[has - j - 1]
        return out

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        """Context vectors with a last component of 1, so that a product with vectors and biases gives scores."""
        out = np.ones((contexts.shape[1], WIDTH + 1), np.float32)
        total = self.c[0] * self.r.take(contexts[0], 0)
        for j in range(1, CONTEXT):
            total += self.c[j] * self.r.take(contexts[j], 0)
        out[:, :WIDTH] = total
        return out

    def log10_class(self, classes: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Normalised log10-probability of each token's class, by batched matrix products."""
        out, turned = np.empty(len(classes)), np.concatenate([self.q.T, self.b[None]])
        room = np.empty((SCORED_AT_ONCE, self.n), np.float32)  # used again and again, so it stays in cache
        for s in range(0, len(classes), SCORED_AT_ONCE):
            p = self.predicted(contexts[:, s:s + SCORED_AT_ONCE])
            scores = np.matmul(p, turned, out=room[:len(p)])
            mine = scores[np.arange(len(p)), classes[s:s + SCORED_AT_ONCE]]
            np.exp(scores, out=scores)
            out[s:s + SCORED_AT_ONCE] = mine - np.log(scores.sum(1))
        return out / math.log(10)

    def parameters(self) -> list[np.ndarray]:
        return [self.r, self.c, self.q, self.b]

    def with_parameters(self, flat: np.ndarray) -> Model:
        parts = np.split(flat.astype(np.float32), np.cumsum([x.size for x in self.parameters()])[:-1])
        return replace(self, **{k: x.reshape(old.shape).copy() for k, x, old in zip("rcqb", parts, self.parameters())})


def new_model(counts: Counts, classes: int, seed: int = 3, hashed: int = 0) -> Model:
    kinds = counts.kinds
    single = kinds == RARE
    single[np.lexsort((counts.keys, -counts.counts))[:classes]] = True
    n_single = int(single.sum())
    slot = np.where(single, np.cumsum(single) - 1, n_single + kinds)
    rare = np.array(counts.n[:RARE], np.float64) - np.bincount(kinds[single], counts.counts[single], RARE + 1)[:RARE]
    freq = np.concatenate([counts.counts[single], rare]) + 1.0
    freq /= freq.sum()
    rng, n, f = np.random.default_rng(seed), len(freq), np.float32
    return Model(counts, slot, n_single, freq, (0.1 * rng.standard_normal((n + 1 + RARE * hashed, WIDTH))).astype(f), np.ones((CONTEXT, WIDTH), f),
                 np.zeros((n, WIDTH), f), np.log(freq).astype(f), hashed)


def _scattered(shape: tuple[int, int], rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A matrix with ``values`` added to ``rows``, a column at a time."""
    out = np.empty(shape)
    for j, column in enumerate(np.ascontiguousarray(values.T, np.float64)):
        out[:, j] = np.bincount(rows, column, shape[0])
    return out


def train_step(m: Model, seen: list[np.ndarray], classes: np.ndarray, contexts: np.ndarray, rng: np.random.Generator, rate: float, room: np.ndarray) -> None:
    """One minibatch of noise-contrastive estimation, in place; ``seen`` holds the squares of all gradients so far."""
    noise = rng.choice(m.n, NOISE, p=m.freq)
    offset = m.b - np.log(NOISE * m.freq).astype(np.float32)
    p1 = m.predicted(contexts)
    p, q_data, q_noise = p1[:, :WIDTH], m.q.take(classes, 0), m.q[noise]
    pull = 1 / (1 + np.exp(np.einsum("ij,ij->i", p, q_data) + offset[classes]))       # 1 - P(data | token seen)
    push = np.matmul(p1, -np.concatenate([q_noise.T, offset[None, noise]]), out=room[:len(p)])
    np.exp(push, out=push)
    push += 1
    np.divide(-1, push, out=push)                                                     # - P(data | noise)
    d_p = pull[:, None] * q_data + push @ q_noise
    d_q = _scattered(m.q.shape, classes, pull[:, None] * p)
    back = push.T @ p1
    np.add.at(d_q, noise, back[:, :WIDTH])
    d_b = np.bincount(classes, pull, m.n)
    np.add.at(d_b, noise, back[:, WIDTH])
    d_c = np.zeros(m.c.shape)
    for j in range(CONTEXT):
        d_c[j] = np.einsum("ij,ij->j", m.r.take(contexts[j], 0), d_p)
    d_r = _scattered(m.r.shape, contexts.reshape(-1), (m.c[:, None] * d_p).reshape(-1, WIDTH))
    for x, d, s in zip(m.parameters(), (d_r, d_c, d_q, d_b), seen):
        s += d * d
        x += (rate * d / np.sqrt(s + 1e-6)).astype(np.float32)


def coded_texts(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of coded texts: the codes of all tokens, and where each text's begin."""
    for _, _, data, offsets in text_slices(column, CODED_SLICE):
        yield data.view("<u2").astype(np.int64), offsets // 2


def _train_partition(batches: Iterator[pa.RecordBatch], model, rate: float, seed: int) -> Iterator[pa.RecordBatch]:
    """This partition's parameters after one pass over its training texts, times its number of tokens."""
    m = model.value.with_parameters(np.concatenate([x.reshape(-1) for x in model.value.parameters()]))
    seen = [np.zeros(x.shape) for x in m.parameters()]
    rng, n, room = np.random.default_rng([seed, TaskContext.get().partitionId()]), 0, np.empty((BATCH, NOISE), np.float32)
    for batch in batches:
        for codes, bounds in coded_texts(batch.column(0)):
            classes, places = m.decoded(codes)
            contexts = m.contexts(places, bounds)
            order = rng.permutation(len(classes))
            for s in range(0, len(order), BATCH):
                at = order[s:s + BATCH]
                train_step(m, seen, classes.take(at), contexts.take(at, 1), rng, rate, room)
            n += len(order)
    if n:
        flat = np.concatenate([x.reshape(-1) for x in m.parameters()]).astype(np.float64) * n
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())], names=["tokens", "parameters"])


def _add_up(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x) for x in table["parameters"].to_pylist())
    return pa.table([pa.array([sum(table["tokens"].to_pylist())], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["tokens", "parameters"])


def train(coded: DataFrame, m: Model, rounds: int = ROUNDS, rate: float = RATE) -> Model:
    """The model after ``rounds`` passes over the training texts of ``coded``."""
    spark = coded.sparkSession
    training = coded.where("__train").select("__classes")
    for i in range(rounds):
        shared = spark.sparkContext.broadcast(m)
        parts = training.mapInArrow(lambda it: _train_partition(it, shared, rate / (i + 1), i), "tokens long, parameters binary")
        # Added up in groups first: the driver gets few parameter sets whatever the number of partitions.
        sums = parts.withColumn("g", F.pmod(F.xxhash64("parameters"), F.lit(16))).groupBy("g").applyInArrow(_add_up, "tokens long, parameters binary").collect()
        if not sums:
            break
        m = m.with_parameters(sum(np.frombuffer(r["parameters"]) for r in sums) / sum(r["tokens"] for r in sums))
    return m


# ---- the words outside the head -------------------------------------------------------------------------------------

_TOKEN = np.dtype([("train", "<u4"), ("context", "<u2", (CONTEXT,))])
_TOKENS = "bucket int, batch long, keys binary, numbers binary, extra binary, docs binary"


def _tokens_dealt(batches: Iterator[pa.RecordBatch], model, buckets: int) -> Iterator[pa.RecordBatch]:
    """All tokens outside the head of each distinct text of a batch, with their contexts and how many training copies the text has, by bucket."""
    serial, m = TaskContext.get().partitionId() << 32, model.value
    for batch in batches:
        if not batch.num_rows:
            continue
        names, first, which = np.unique(batch.column(0).to_numpy(), return_index=True, return_inverse=True)
        training = np.bincount(which, batch.column(1).to_numpy(zero_copy_only=False).astype(float), len(names)).astype(np.int64)
        held: list[tuple] = []
        pairs, begin = 0, 0
        for lo, hi, keys, bounds in tokens(batch.column(2).take(pa.array(first))):
            classes = m.classes(keys)
            contexts = m.contexts(m.decoded(m.codes(keys, classes))[1], bounds)
            at = np.flatnonzero(classes >= m.single)
            text = np.repeat(np.arange(lo, hi), np.diff(bounds))[at]
            edges = np.searchsorted(text, np.arange(lo, hi + 1))    # the tokens of each text
            some = lo
            while some < hi:
                to = min(hi, begin + exchange.MAX_DOCS, max(some + 1, lo + int(np.searchsorted(edges, edges[some - lo] + exchange.MAX_PAIRS - pairs, "right")) - 1))
                s = slice(edges[some - lo], edges[to - lo])
                extra = np.zeros(s.stop - s.start, _TOKEN)
                extra["train"], extra["context"] = training[text[s]], contexts[:, at[s]].T
                held.append((keys[at[s]], text[s] - begin, extra))
                pairs += len(extra)
                some = to
                if pairs >= exchange.MAX_PAIRS or to - begin >= exchange.MAX_DOCS or to < hi or to == len(names):
                    docs = np.zeros(to - begin, _DOC)
                    docs["text"] = names[begin:to]
                    # Never hot: a bucket's tokens stream by.
                    out = exchange.pack(serial, *(np.concatenate(x) for x in zip(*held)), docs.tobytes(), buckets, 1 << 60).drop_columns(["hot"])
                    extra = [np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, _TOKEN.itemsize).T).tobytes() for x in out["extra"]]
                    yield out.set_column(out.schema.names.index("extra"), "extra", pa.array(extra, pa.binary()))   # byte by byte, which compresses
                    serial += 1
                    held, pairs, begin = [], 0, to


class Leaves:
    """The words of a bucket: sorted, ``LEAF`` of one rare class to a leaf, with their counts and vectors."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, where = np.unique(keys, return_inverse=True)
        self.count = np.bincount(where, counts, len(self.keys)).astype(np.int64)
        kind = rare_class(self.keys)
        first = np.searchsorted(kind, np.arange(RARE + 1))
        in_kind = np.arange(len(self.keys)) - first[kind]
        before = np.concatenate([[0], np.cumsum(-(-np.diff(first) // LEAF))])    # leaves of the classes before
        self.place = (before[kind] + in_kind // LEAF) * LEAF + in_kind % LEAF    # of each word among the leaves' places
        n = int(before[-1])
        self.share = np.zeros((n, LEAF))
        self.share.reshape(-1)[self.place] = self.count + 1.0
        self.share = (self.share / self.share.sum(1, keepdims=True)).astype(np.float32)
        self.q = np.zeros((n * LEAF, WIDTH), np.float32)
        self.seen = np.zeros((n * LEAF, WIDTH))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys training has seen, and their words."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, at

    def train_step(self, place: np.ndarray, p: np.ndarray, weight: np.ndarray, rng: np.random.Generator, rate: float) -> None:
        """One minibatch of noise-contrastive estimation; the noise of a token are words of other tokens of its leaf, so as frequent as training has them."""
        order = np.argsort(place, kind="stable")
        place, p, weight = place[order], p[order], weight[order]
        leaf = place // LEAF
        new = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1]))
        size = np.diff(np.append(new, len(leaf)))
        start, size = np.repeat(new, size), np.repeat(size, size)
        drawn = [place] + [place[start + (rng.random(len(place)) * size).astype(np.int64)] for _ in range(LEAF_NOISE)]
        d = []
        for i, x in enumerate(drawn):
            odds = np.exp(np.einsum("ij,ij->i", p, self.q[x])) / LEAF_NOISE         # data against noise
            d.append(((weight / (1 + odds)) if i == 0 else (-weight * odds / (1 + odds)))[:, None] * p)
        rows, where = np.unique(np.concatenate(drawn), return_inverse=True)
        d = _scattered((len(rows), WIDTH), where, np.concatenate(d))
        self.seen[rows] += d * d
        self.q[rows] += (rate * d / np.sqrt(self.seen[rows] + 1e-6)).astype(np.float32)

    def log10_in_leaf(self, place: np.ndarray, p: np.ndarray) -> np.ndarray:
        """What the vectors add to the log10 of a word's share."""
        out, q = np.empty(len(place)), self.q.reshape(-1, LEAF, WIDTH)
        for s in range(0, len(place), 4096):
            x, leaf = place[s:s + 4096], place[s:s + 4096] // LEAF
            e = np.matmul(q[leaf], p[s:s + 4096, :, None])[:, :, 0]
            mine = e[np.arange(len(x)), x % LEAF]
            out[s:s + 4096] = mine - np.log(np.einsum("ij,ij->i", np.exp(e, out=e), self.share[leaf]))
        return out / math.log(10)


_TAIL_ANSWER = "batch long, sums binary, known binary, tail binary, docs binary"


def _tail(batches: Iterator[pa.RecordBatch], model, rate: float) -> Iterator[pa.RecordBatch]:
    """Buckets one after the other, of each first the counts of its words and then its tokens: these train the vectors as they come, are put
    aside in a file, and are scored when all have come.  For each batch the sums over its texts."""
    m = model.value
    now, counted, leaves, aside, waiting, rng = None, [], None, None, [], None

    def block(row: dict) -> tuple:
        keys, numbers = exchange.from_planes(row["keys"]), np.frombuffer(row["numbers"], "<u2")
        extra = np.ascontiguousarray(np.frombuffer(row["extra"], np.uint8).reshape(_TOKEN.itemsize, -1).T).view(_TOKEN).reshape(-1)
        known, at = leaves.find(keys)
        return numbers, extra, known, at

    def contexts(extra: np.ndarray) -> np.ndarray:
        return m.predicted(np.ascontiguousarray(extra["context"].T).astype(np.int64))[:, :WIDTH]

    def train() -> None:
        nonlocal waiting
        if waiting:
            place, extra = (np.concatenate(x) for x in zip(*waiting))
            for s in range(0, len(place), LEAF_BATCH):
                some = extra[s:s + LEAF_BATCH]
                leaves.train_step(place[s:s + LEAF_BATCH], contexts(some), some["train"].astype(np.float32), rng, rate)
        waiting = []

    def scored() -> Iterator[pa.RecordBatch]:
        if aside is None:
            return
        train()
        aside.seek(0)
        while True:
            try:
                row = pickle.load(aside)
            except EOFError:
                break
            numbers, extra, known, at = block(row)
            n, here = numbers[known], at[known]
            logs = np.log10(leaves.count[here] + 1.0)
            tail = leaves.log10_in_leaf(leaves.place[here], contexts(extra[known]))
            cols = [np.bincount(n, x).astype(np.float64).tobytes() for x in (logs, np.ones(len(n)), tail)]
            yield pa.RecordBatch.from_arrays([pa.array([row["batch"]], pa.int64()), *[pa.array([x], pa.binary()) for x in cols], pa.array([row["docs"]], pa.binary())],
                                             names=["batch", "sums", "known", "tail", "docs"])
        aside.close()

    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch[c][i].as_py() for c in ("bucket", "batch", "keys", "numbers", "extra", "docs")}
            if row["bucket"] != now:
                yield from scored()
                now, counted, leaves, aside, waiting = row["bucket"], [], None, None, []
                rng = np.random.default_rng(now)
            if row["batch"] is None:
                keys, counts = exchange.from_planes(row["keys"]), np.frombuffer(row["numbers"], "<u4")
                outside = m.classes(keys) >= m.single
                counted.append((keys[outside], counts[outside]))
                continue
            if leaves is None:
                leaves = Leaves(*(np.concatenate(x) for x in zip(*counted))) if counted else Leaves(np.zeros(0, np.uint64), np.zeros(0))
                counted, aside = [], tempfile.TemporaryFile()
            pickle.dump(row, aside)
            _, extra, known, at = block(row)
            learnt = known & (extra["train"] > 0)
            if learnt.any():
                waiting.append((leaves.place[at[learnt]], extra[learnt]))
            if sum(len(x) for x, _ in waiting) >= LEAF_BATCH:
                train()
    yield from scored()


def _gather_tail(table: pa.Table) -> pa.Table:
    """One batch: the sums over all buckets for each of its texts."""
    rows = table.to_pylist()
    docs = np.frombuffer(b"".join(r["docs"] for r in rows if r["docs"] is not None), _DOC)
    out = np.zeros((3, len(docs)))
    for r in rows:
        for total, c in zip(out, ("sums", "known", "tail")):
            x = np.frombuffer(r[c])
            total[:len(x)] += x
    return pa.table([pa.array(docs["text"].astype(np.int64)), pa.array(out[0]), pa.array(out[1].astype(np.int64)), pa.array(out[2])], names=["text", "log_counts", "known", "tail"])


def tail_scores(texts: DataFrame, words: DataFrame, m: Model, buckets: int, rate: float = RATE) -> DataFrame:
    """``(text, log_counts, known, tail)`` over the words of each text outside the head: ``tail`` is what their vectors add to the logs of
    their shares.  ``words``: :func:`distinct_words` by the same ``buckets``."""
    shared = texts.sparkSession.sparkContext.broadcast(m)
    dealt = texts.mapInArrow(lambda it: _tokens_dealt(it, shared, buckets), _TOKENS)
    none = [F.lit(None).cast("binary").alias(c) for c in ("extra", "docs")]
    counts = words.select("bucket", F.lit(None).cast("long").alias("batch"), "keys", F.col("counts").alias("numbers"), *none)
    answers = counts.unionByName(dealt).repartitionById(buckets, F.col("bucket")) \
        .sortWithinPartitions("bucket", F.col("batch").asc_nulls_first()) \
        .mapInArrow(lambda it: _tail(it, shared, rate), _TAIL_ANSWER) \
        .groupBy("batch").applyInArrow(_gather_tail, "text long, log_counts double, known long, tail double")
    return answers.groupBy("text").agg(*[F.first(c).alias(c) for c in ("log_counts", "known", "tail")])


# ---- texts ----------------------------------------------------------------------------------------------------------

_STATISTICS = ["__top", "__single", "__top_known", "n_tokens", *[f"__rare{k}" for k in range(RARE)]]


def _code(batches: Iterator[pa.RecordBatch], model, n_own: int) -> Iterator[pa.RecordBatch]:
    """Per text the logs of its frequent words' counts (of all, and of those with a class of their own), how many are
    known, its tokens, its tokens by rare class, and the codes of all tokens (16 bits each)."""
    m = model.value
    logs_of, known_of = np.log10(m.counts.counts + 1.0), m.counts.counts > 0
    for batch in batches:
        out: list[list[np.ndarray]] = [[] for _ in _STATISTICS]
        coded: list[bytes] = []
        for _, _, keys, bounds in tokens(batch.column("__body")):
            found, at = m.counts.find(keys)
            classes = np.where(found, m.slot[at], m.single + rare_class(keys))
            logs = np.where(found, logs_of[at], 0.0)
            values = [sums_by_run(logs, bounds), sums_by_run(np.where(classes < m.single, logs, 0.0), bounds), sums_by_run(found & known_of[at], bounds), np.diff(bounds)]
            values += [sums_by_run(classes == m.single + k, bounds) for k in range(RARE)]
            for o, v in zip(out, values):
                o.append(v)
            raw = m.codes(keys, classes).astype("<u2")
            coded += [raw[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        kinds = [pa.float64()] * 2 + [pa.int64()] * (2 + RARE)
        cols = [pa.array(np.concatenate(o) if o else [], kind) for o, kind in zip(out, kinds)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:n_own], *cols, pa.array(coded, pa.binary())], names=[*batch.schema.names[:n_own], *_STATISTICS, "__classes"])


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """The coded rows with the class part of the score in place of the classes."""
    m = model.value
    for batch in batches:
        own = [np.zeros(0)]
        for codes, bounds in coded_texts(batch.column("__classes")):
            classes, places = m.decoded(codes)
            own.append(sums_by_run(m.log10_class(classes, m.contexts(places, bounds)), bounds))
        rest = batch.drop_columns(["__classes"])
        yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(np.concatenate(own))], names=[*rest.schema.names, "__own"])


def score_texts(docs: DataFrame, training: Column, keep: list[str], text: str = "text", top: int = TOP, classes: int | None = None,
                rounds: int = ROUNDS, rate: float = RATE) -> DataFrame:
    """The columns ``keep`` of ``docs`` with n_tokens, n_known, train_tokens, base_score and score; ``training`` marks what is learnt from.

    Every word of training has a vector; with ``classes`` only so many of the ``top`` most frequent ones."""
    col = F.col
    keep = [c for c in keep if c not in ("n_tokens", "n_known", "train_tokens", "base_score", "score")]
    body = F.coalesce(col(f"`{text}`").cast("string"), F.lit(""))
    texts = docs.select(F.xxhash64(body).alias("text"), F.coalesce(training, F.lit(False)).alias("train"), body.alias("body"))
    # Every text once as the classes of its tokens: training and scoring read these.
    if classes is None:
        buckets, _ = exchange.dealing(texts, "body", bytes_per_byte=2.0)
        words = stored(distinct_words(texts, buckets), "distinct-words")
        counts = count_tokens(texts, CLASSES, words)
        model = new_model(counts, CLASSES + 1, hashed=HASHED)  # with the end
    else:
        counts = count_tokens(texts, top)
        model = new_model(counts, classes)
    start = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(*[col(f"`{c}`") for c in keep], F.coalesce(training, F.lit(False)).alias("__train"), F.xxhash64(body).alias("__text"), body.alias("__body"))
    fields = own.schema.fields[:-1]
    of = lambda fs: [f"`{f.name}` {f.dataType.simpleString()}" for f in fs]
    schema = ", ".join(of(fields) + [f"{c} {'double' if i < 2 else 'long'}" for i, c in enumerate(_STATISTICS)] + ["__classes binary"])
    coded = stored(own.mapInArrow(lambda it: _code(it, start, len(fields)), schema), "coded")
    model = train(coded, model, rounds, rate)
    if classes is None:
        logs = stored(tail_scores(texts, words, model, buckets, rate), "word-scores")
    else:
        logs = stored(log_counts(texts, counts), "log-counts").withColumn("tail", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = coded.mapInArrow(lambda it: _score(it, shared), ", ".join(of(coded.schema.fields[:-1]) + ["__own double"]))
    out = scored.join(logs.toDF("__text", "__log_counts", "__known", "__tail"), "__text", "left")
    # A rare word's share of its class: (count + 1) / (tokens + words + 1) over the rare words of that class.
    n, v = sum(counts.n), sum(counts.v)
    score = col("__own") + col("__log_counts") + col("__top") - col("__single") + col("__tail")
    is_single, kinds = model.slot < model.single, counts.kinds
    for k in range(RARE):
        mine = is_single & (kinds == k)
        score = score - col(f"__rare{k}") * math.log10(counts.n[k] - int(counts.counts[mine].sum()) + counts.v[k] - int(mine.sum()) + 1)
    base = col("__log_counts") + col("__top") - col("n_tokens") * math.log10(n + v + 1)
    return out.select(*[col(f"`{c}`") for c in keep], "n_tokens", (col("__known") + col("__top_known")).alias("n_known"),
                      F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))
