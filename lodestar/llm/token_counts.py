"""Token counts of a unigram vocabulary, without the tokens: a count-only Viterbi pass.

A text is cut into words before every space (also before U+2581, which stands
for a space), and a word is spelt ``U+2581`` and its characters.  An Aho-Corasick
automaton of the vocabulary lists all pieces that end at each character; the
best path carries its score and its number of pieces and nothing else.

Tie rules of unigram tokenizers: of several paths of one score to a place, the one
whose last piece starts first stays; where no piece is the one character that
starts at a place, that character is an unknown piece at the least score of
the vocabulary less 10; unknown pieces in a row count as one.

Every task asks once for each word it has not met, by a hash of 64 bits, so the
cost follows the different words.  Nothing is shuffled; the vocabulary is a
parameter of some ten thousand pieces and is broadcast.

Defined results: a null or empty text has no tokens and score 0; a text of spaces has
the pieces of its empty words; repeated rows count alike; columns named like a
result are replaced; without pieces every run of characters is one unknown piece.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodestar.llm.bytescan import hash_spans, sums_by_run, text_slices

SPACE = "\u2581"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 2_000_000


def zipf_pieces(model_file: str) -> tuple[list[str], list[float]]:
    """The pieces of a sentencepiece file and a log-probability for each, falling with its rank ``r`` as ``1 / (r + 1)``.

    The file's own scores are merge ranks, which are no probabilities; ids are in order of rank.
    """
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    total = math.log(sum(1 / (r + 1) for r in range(1, len(ids) + 1)))
    return [sp.id_to_piece(i) for i in ids], [-math.log(r + 1) - total for r in range(1, len(ids) + 1)]


class WordCounter:
    def __init__(self, pieces: Sequence[str], scores: Sequence[float]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for p, s in zip(pieces, scores):
            if p and not self.automaton.exists(p):
                self.automaton.add_word(p, (len(p), float(s)))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.unknown = min(scores, default=0.0) - UNKNOWN_PENALTY
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)
        self.scores = np.zeros(0)

    def word(self, word: str) -> tuple[int, float]:
        """Pieces and score of the best path through one word."""
        n = len(word)
        best, count, open_unknown = [-math.inf] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        best[0] = 0.0
        ending: list[list] = [[] for _ in range(n)]
        if len(self.automaton):
            for end, found in self.automaton.iter(word):
                ending[end].append(found)
        for end in range(n):
            top, pieces, unknown, single = -math.inf, 0, False, False
            for length, score in sorted(ending[end], reverse=True):  # the first start first
                start = end + 1 - length
                if best[start] + score > top:
                    top, pieces = best[start] + score, count[start] + 1
                single = single or length == 1
            if not single and best[end] + self.unknown > top:
                top, unknown = best[end] + self.unknown, True
                pieces = count[end] + (0 if open_unknown[end] else 1)
            best[end + 1], count[end + 1], open_unknown[end + 1] = top, pieces, unknown
        return count[n], best[n]

    def count(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Pieces and score of every text."""
        counts, scores = [np.zeros(0, np.int64)], [np.zeros(0)]
        for _, _, data, offsets in text_slices(column):
            cut = np.zeros(len(data) + 1, bool)
            space = data == 0x20
            wide = np.zeros(len(data), bool)
            if len(data) > 2:
                wide[:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
            cut[:-1] = space | wide
            cut[offsets] = True
            bounds = np.flatnonzero(cut)
            starts, ends = bounds[:-1], bounds[1:]
            if not len(starts):
                counts.append(np.zeros(len(offsets) - 1, np.int64))
                scores.append(np.zeros(len(offsets) - 1))
                continue
            begin = starts + space[starts] + 3 * wide[starts]
            uniq, first, inverse = np.unique(hash_spans(data, begin, ends), return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(self.keys, uniq), max(len(self.keys) - 1, 0))
            new = np.flatnonzero(self.keys[at] != uniq) if len(self.keys) else np.arange(len(uniq))
            if len(self.keys) + len(new) > CACHE_WORDS:
                self._clear()
                new = np.arange(len(uniq))
            raw, s, e = data.tobytes(), begin[first[new]].tolist(), ends[first[new]].tolist()
            found = [self.word(SPACE + raw[i:j].decode("utf-8", "replace")) for i, j in zip(s, e)]
            at = np.searchsorted(self.keys, uniq[new])
            self.keys = np.insert(self.keys, at, uniq[new])
            self.counts = np.insert(self.counts, at, np.array([c for c, _ in found], np.int64))
            self.scores = np.insert(self.scores, at, np.array([c for _, c in found], np.float64))
            slot = np.searchsorted(self.keys, uniq)[inverse]
            edges = np.searchsorted(starts, offsets)
            counts.append(sums_by_run(self.counts[slot], edges))
            scores.append(sums_by_run(self.scores[slot], edges))
        return np.concatenate(counts), np.concatenate(scores)


_counters: dict[int, WordCounter] = {}


def count_pieces(docs: DataFrame, pieces: Sequence[str], scores: Sequence[float], keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default), ``n_tokens`` and ``log_score`` (of the best path)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_tokens", "log_score")]
    shared = docs.sparkSession.sparkContext.broadcast((list(pieces), list(scores)))
    name = hash((tuple(pieces), tuple(scores)))
    rows = docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.get(name)  # a worker keeps what it knows from task to task
        if counter is None:
            _counters.clear()
            counter = _counters[name] = WordCounter(*shared.value)
        for batch in batches:
            counts, scores = counter.count(batch.column("__text"))
            rest = batch.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(counts), pa.array(scores)], names=[*rest.schema.names, "n_tokens", "log_score"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["n_tokens long, log_score double"])
    return rows.mapInArrow(run, schema)
