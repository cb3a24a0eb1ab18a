"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words.  Each passage is encoded as a
small vector of counts from its bytes and words (kinds of characters, word
lengths, repetition inside the passage and of earlier text of the document).
A hidden layer makes each passage's representation ``h``; a gated attention

    weight = softmax over the document of  w . (tanh(V h) * sigmoid(U h))

weighs the passages, and the weighted representation of the document gets a
logistic score: the probability of label 1.  All layers are learnt together from
document labels alone, with Adam, in numpy on the driver.

The training bags are the labelled documents of lowest hash of their id, at most
``SAMPLE`` of them: the one bounded sample here, of different (id, label) pairs and
then of different texts with them, so that neither repeated label rows nor an id's
many document rows fill it.  Equal texts with one label are one bag with a weight.  Only
the bags' passage vectors come to the driver.  Scoring reads every passage of every whole text where it
lies; nothing is shuffled.  Labels, ids, languages and sources are never inputs.

Defined results: a null or empty text is one empty passage and gets a score; a
text of any length is scored whole; documents with several labels are
trained on with each, once however often the rows are repeated; without both labels in the sample the score is the share of
label 1 (0.5 without labels); repeated rows get equal scores; columns named like
a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.bytescan import NOT_SPACE, find_words, hash_spans, hash_windows, lower_ascii, mix, ragged_arange, text_slices, window_starts
from lodestar.llm.components import stored

PASSAGE = 64
SAMPLE = 3_000
HIDDEN = 24
GATE = 12
STEPS = 150
RATE = 0.03

#: Kinds of bytes whose share in a passage is counted, as ranges of byte values.
KINDS = [[(65, 90)], [(97, 122)], [(48, 57)], [(0x80, 0xFF)], [(33, 33), (63, 63)], [(44, 44), (46, 46), (58, 59)], [(124, 124)],
         [(35, 38), (42, 43), (61, 61), (64, 64), (94, 94), (126, 126)], [(10, 10)], [(0, 8), (14, 31), (127, 127)],
         [(34, 34), (39, 41), (45, 45), (47, 47), (60, 60), (62, 62), (91, 93), (95, 96), (123, 123), (125, 125)]]
FEATURES = len(KINDS) + 14


def _member(ranges: list[tuple[int, int]]) -> np.ndarray:
    table = np.zeros(256, np.float32)
    for lo, hi in ranges:
        table[lo:hi + 1] = 1
    return table


_KIND = np.stack([_member(r) for r in KINDS], 1)
#: Four kinds to a 64-bit number, 16 bits each, so that one running sum counts four kinds.
_LANES = [sum((_KIND[:, j + i].astype(np.uint64) << np.uint64(16 * i) for i in range(min(4, len(KINDS) - j))), np.zeros(256, np.uint64))
          for j in range(0, len(KINDS), 4)]


def _repeats(codes: np.ndarray) -> np.ndarray:
    """Which values occurred before in ``codes``."""
    order = np.argsort(codes, kind="stable")
    out = np.zeros(len(codes), bool)
    out[order[1:]] = codes[order[1:]] == codes[order[:-1]]
    return out


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of all texts, and for each text the number of its first passage (one more at the end)."""
    starts, ends, first = find_words(data, offsets, NOT_SPACE)
    n_words = np.diff(first)
    n_pass = np.maximum(1, -(-n_words // PASSAGE))
    bounds = np.concatenate([[0], np.cumsum(n_pass)])
    text = np.repeat(np.arange(len(n_words)), n_pass)
    rank = np.arange(bounds[-1]) - bounds[text]
    a = np.minimum(first[text] + rank * PASSAGE, first[text + 1])      # words of each passage
    b = np.minimum(a + PASSAGE, first[text + 1])
    x = np.zeros((len(a), FEATURES), np.float32)
    full = np.flatnonzero(b > a)
    if not len(full):
        return x, bounds
    a, b = a[full], b[full]
    n = (b - a).astype(np.float32)
    s, e = starts[a], ends[b - 1]
    size, k = e - s, len(KINDS)
    counts = np.zeros((len(full), 4 * len(_LANES)), np.float32)
    for j, lane in enumerate(_LANES):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lane[data])])
        packed = total[e] - total[s]
        for i in range(4):
            counts[:, 4 * j + i] = (packed >> np.uint64(16 * i)) & np.uint64(0xFFFF)
    for i in np.flatnonzero(size > 0xFFFF).tolist():  # a count may not fit its 16 bits
        counts[i, :k] = np.bincount(data[s[i]:e[i]], minlength=256) @ _KIND
    x[full, :k] = counts[:, :k] / size[:, None]
    length = (ends - starts).astype(np.float32)
    word_of = np.repeat(np.arange(len(full)), b - a)
    words = ragged_arange(a, b - a)
    mean = lambda v: np.bincount(word_of, v[words], len(full)) / n
    lowered = lower_ascii(data)
    h = hash_spans(lowered, starts, ends)
    of_text = np.repeat(np.arange(len(n_words), dtype=np.uint64), n_words) * np.uint64(0x9E3779B97F4A7C15)
    in_passage = np.zeros(len(starts), bool)
    in_passage[words] = _repeats(mix(h[words] + word_of.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))
    before, before2 = np.zeros(len(h), bool), np.zeros(len(h), bool)
    before[1:] = h[1:] == h[:-1]
    before2[2:] = h[2:] == h[:-2]
    heads = first[:-1][n_words > 0]
    before[heads] = before2[heads] = False  # not across texts
    before2[heads[n_words[n_words > 0] > 1] + 1] = False
    run = np.zeros(len(h), bool)  # five words that stood in this text before
    at5 = window_starts(first, 5)
    if len(at5):
        run[at5] = _repeats(mix(hash_windows(h, at5, 5) + of_text[at5]))
    last, head = data[ends - 1], data[starts]
    m = mean(length)
    cols = [np.log1p(n), m / 8, np.sqrt(np.maximum(mean(length * length) - m * m, 0)) / 8, mean(length <= 3), mean(length >= 14), mean(in_passage), mean(before),
            mean(before2), mean(run), mean((head >= 65) & (head <= 90)), mean((last == 46) | (last == 33) | (last == 63)), mean(last == 44),
            mean(~(((last | 32) >= 97) & ((last | 32) <= 122)) & (last < 0x80)), np.ones(len(full))]
    for j, c in enumerate(cols):
        x[full, k + j] = c
    return x, bounds


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None   # the score if there was nothing to learn

    def score(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bounds) - 1, self.constant)
        return 1 / (1 + np.exp(-np.clip(_forward(self.weights, self.prepare(x), bounds)["logit"], -30, 30)))

    def prepare(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)


def _segments(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, bounds[:-1], axis=0)  # every bag has a passage


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    size = np.diff(bounds)
    h = np.tanh(x @ w["W"] + w["a"])
    t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    e = (t * g) @ w["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, bounds[:-1]), size))
    alpha = e / np.repeat(_segments(e, bounds), size)
    z = _segments(alpha[:, None] * h, bounds)
    return {"h": h, "t": t, "g": g, "alpha": alpha, "z": z, "logit": z @ w["c"] + w["d"][0]}


def learn(x: np.ndarray, bounds: np.ndarray, labels: np.ndarray, steps: int = STEPS, rate: float = RATE, seed: int = 5,
          weights: np.ndarray | None = None) -> Model:
    """Fit all layers to document labels by Adam on the mean log loss; ``weights`` says how many documents each bag stands for."""
    weights = np.ones(len(labels)) if weights is None else weights
    mean, scale = np.zeros(x.shape[1]), np.ones(x.shape[1])
    if len(x):
        each = np.repeat(weights, np.diff(bounds))
        mean = np.average(x, 0, each)
        scale = (np.sqrt(np.average((x - mean) ** 2, 0, each)) + 1e-3).astype(x.dtype)
        mean = mean.astype(x.dtype)
    share = float(np.average(labels, weights=weights)) if len(labels) else 0.5
    if not len(labels) or share in (0.0, 1.0):
        return Model(mean, scale, {}, share)
    rng = np.random.default_rng(seed)
    init = lambda *s: rng.standard_normal(s) / np.sqrt(s[0])
    w = {"W": init(x.shape[1], HIDDEN), "a": np.zeros(HIDDEN), "V": init(HIDDEN, GATE), "U": init(HIDDEN, GATE), "w": init(GATE),
         "c": init(HIDDEN), "d": np.array([np.log(share / (1 - share))])}
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    model = Model(mean, scale, w)
    v, size = model.prepare(x), np.diff(bounds)
    for i in range(1, steps + 1):
        f = _forward(w, v, bounds)
        d_logit = (1 / (1 + np.exp(-f["logit"])) - labels) * weights / weights.sum()
        d_z = np.repeat(d_logit[:, None] * w["c"], size, 0)
        d_alpha = (d_z * f["h"]).sum(1)
        d_e = f["alpha"] * (d_alpha - np.repeat(_segments(f["alpha"] * d_alpha, bounds), size))
        d_tg = d_e[:, None] * w["w"]
        d_t, d_g = d_tg * f["g"] * (1 - f["t"] ** 2), d_tg * f["t"] * f["g"] * (1 - f["g"])
        d_h = f["alpha"][:, None] * d_z + d_t @ w["V"].T + d_g @ w["U"].T
        d_in = d_h * (1 - f["h"] ** 2)
        grads = {"W": v.T @ d_in + 1e-4 * w["W"], "a": d_in.sum(0), "V": f["h"].T @ d_t, "U": f["h"].T @ d_g,
                 "w": (f["t"] * f["g"]).T @ d_e, "c": f["z"].T @ d_logit + 1e-4 * w["c"], "d": np.array([d_logit.sum()])}
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] -= rate * (first[k] / (1 - 0.9 ** i)) / (np.sqrt(second[k] / (1 - 0.999 ** i)) + 1e-8)
    return model


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The passage vectors of each text, as one binary."""
    for batch in batches:
        out = []
        for _, _, data, offsets in text_slices(batch.column("__text")):
            x, bounds = passages(data, offsets)
            out += [x[bounds[i]:bounds[i + 1]].tobytes() for i in range(len(bounds) - 1)]
        yield pa.RecordBatch.from_arrays([batch.column("__label"), batch.column("__weight"), pa.array(out, pa.binary())], names=["label", "weight", "x"])


def fit(docs: DataFrame, labels: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE) -> Model:
    """A model from the rows of ``labels`` that ``training`` (over its doc_id) marks."""
    chosen = labels.where(training & F.col(f"`{label}`").isin(0, 1) & F.col(f"`{doc_id}`").isNotNull()).select(
        F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{label}`").cast("double").alias("__label")).distinct()
    chosen = chosen.orderBy(F.xxhash64("__id"), "__id", "__label").limit(sample)  # a bounded table, so it may be broadcast
    bags = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text")) \
        .join(F.broadcast(chosen), "__id").distinct()
    bags = stored(bags, "bags")
    texts = bags.groupBy("__id", "__label").agg(F.count("*").alias("__texts"))  # as few rows as the sample
    # If ids have several texts, about as many from each: places in the order of a hash, spread over the id's number of texts.
    place = F.pmod(F.xxhash64("__id", "__text"), F.lit(1 << 40)) * F.col("__texts")
    bags = bags.join(F.broadcast(texts), ["__id", "__label"]).orderBy(place, "__id", "__text", "__label").limit(sample)
    bags = bags.groupBy("__label", "__text").agg(F.count("*").cast("double").alias("__weight"))
    rows = bags.mapInArrow(_vectors, "label double, weight double, x binary").orderBy("x", "label", "weight").collect()
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in rows]
    bounds = np.concatenate([[0], np.cumsum([len(v) for v in x])]).astype(np.int64)
    return learn(np.concatenate(x) if x else np.zeros((0, FEATURES), np.float32), bounds, np.array([r["label"] for r in rows]),
                 weights=np.array([r["weight"] for r in rows]))


def score_documents(docs: DataFrame, model: Model, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) and ``score``."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)] + [shared.value.score(*passages(data, offsets)) for _, _, data, offsets in text_slices(batch.column("__text"))]
            rest = batch.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(np.concatenate(scores))], names=[*rest.schema.names, "score"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["score double"])
    return rows.mapInArrow(run, schema)
