"""Alignment of two tokenizers' tokens of the same bytes, by products of sparse incidence matrices.

Both tokenizers spell one string of bytes, so a token is a range of its bytes.  A token by byte
*incidence matrix* has a one where a token holds a byte; it is kept as compressed rows (``Csr``).
Row products after Gustavson (``product``) take, for each row of the first matrix, the
rows of the second that its entries name, and add them up:

* ``A . B^T`` over bytes gives the *overlap links*: pairs of tokens that share bytes, and how
  many.  Of these, pairs whose ranges end together are the links that are counted.
* Places where a token of both ends cut the string into *groups*.  ``GA . GB^T`` over groups gives the
  *shared-group links*: pairs of tokens in one group.

Counts.  How many links of the corpus hold a pair of ids linked is summed by Spark, partly within each
task.  Where two tokens end together, the shorter one's bytes end the longer one's,
so the pairs possible are bounded by the vocabularies (``possible_pairs``: every byte string's ends,
some hundred thousand), however large the corpus is; so the counts are collected and broadcast.

Every text is encoded once; the ids are written to the shared folder and read for the counts and for
the result.  Documents are never shuffled.  Texts are worked off in slices of half a megabyte, longer texts by themselves.

Texts that the tokens of either side do not spell byte by byte (such as those that hold U+2581, which
stands for a space in pieces) have no tokens.  Strings of special tokens are ordinary text.

Defined results: null and empty texts, and texts that are not spelt, have no tokens: zeros and an empty digest;
repeated rows count as often as they are there; an empty table gives an empty result; columns named like
a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.bytescan import ragged_arange, string_buffers, text_slices
from lodestar.llm.components import stored
from lodestar.llm.encoding import ChunkEncoder, encoder

SPACE = "▁"
REMEMBERED = 400_000  # chunks for each side
SLICE = 1 << 19       # bytes of text, or of the first side's ids, worked off at a time


# ---- sparse matrices ------------------------------------------------------------------------------------------------

@dataclass
class Csr:
    """Rows of ones: the columns of row i are ``indices[indptr[i]:indptr[i + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def transposed(self) -> Csr:
        row = np.repeat(np.arange(self.rows), np.diff(self.indptr))
        counts = np.bincount(self.indices, minlength=self.columns)
        return Csr(np.concatenate([[0], np.cumsum(counts)]), row[np.argsort(self.indices, kind="stable")], self.rows)


def product(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, column, value)`` of the entries of ``a . b``, by row and column.

    Row i is the sum of the rows of ``b`` that the entries of row i of ``a`` name: these are laid out one
    after the other for all rows, and entries of one place are added up.
    """
    size = np.diff(b.indptr)[a.indices]
    row = np.repeat(np.repeat(np.arange(a.rows), np.diff(a.indptr)), size)
    place = row * b.columns + b.indices[ragged_arange(b.indptr[a.indices], size)]
    if np.any(place[1:] < place[:-1]):
        place = np.sort(place)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
    value = np.diff(np.append(first, len(place)))
    place = place[first]
    return place // max(b.columns, 1), place % max(b.columns, 1), value


def byte_incidence(ends: np.ndarray) -> Csr:
    """Tokens by bytes, for tokens that follow one another and end (exclusive) at ``ends``."""
    total = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(total), total)


def group_incidence(group: np.ndarray, groups: int) -> Csr:
    """Tokens by groups."""
    return Csr(np.arange(len(group) + 1), group, groups)


@dataclass
class Aligned:
    """Tokens of both sides over one run of bytes."""

    ends_a: np.ndarray
    ends_b: np.ndarray
    cuts: np.ndarray         # where tokens of both end

    @property
    def group_a(self) -> np.ndarray:
        return np.searchsorted(self.cuts, self.ends_a)

    @property
    def group_b(self) -> np.ndarray:
        return np.searchsorted(self.cuts, self.ends_b)

    def overlaps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token numbers of both sides and shared bytes of every overlap link."""
        return product(byte_incidence(self.ends_a), byte_incidence(self.ends_b).transposed())

    def end_links(self) -> tuple[np.ndarray, np.ndarray]:
        """The overlap links whose ranges end together."""
        a, b, _ = self.overlaps()
        together = self.ends_a[a] == self.ends_b[b]
        return a[together], b[together]

    def group_links(self, some: slice = slice(None)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The shared-group links of ``some`` tokens of the first side: a group of m and n tokens has m times n."""
        n = len(self.cuts)
        a, b, value = product(group_incidence(self.group_a[some], n), group_incidence(self.group_b, n).transposed())
        return a + (some.start or 0), b, value


def align(lengths_a: np.ndarray, lengths_b: np.ndarray) -> Aligned:
    """From the bytes of each token; both sides spell the same bytes."""
    ends_a, ends_b = np.cumsum(lengths_a), np.cumsum(lengths_b)
    return Aligned(ends_a, ends_b, np.intersect1d(ends_a, ends_b, assume_unique=True))


# ---- vocabularies and encoders --------------------------------------------------------------------------------------

def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary of the tokenizers library."""
    enc = encoder(path)
    back = {c: b for b, c in enc.symbols.items()}
    out = [b""] * enc.tokenizer.get_vocab_size()
    for token, i in enc.tokenizer.get_vocab().items():
        out[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return out


def piece_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a sentencepiece file: U+2581 is a space, ``<0xHH>`` the byte HH."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in ((i, sp.id_to_piece(i)) for i in range(sp.get_piece_size()))]


class PieceEncoder(ChunkEncoder):
    """Ids of a sentencepiece file for texts that begin with the space that it adds.

    A chunk begins at a run of spaces.  No piece has a space after another character (checked), so
    no merge passes the place between two chunks, and a text's ids are its chunks' ids.
    """

    def __init__(self, path: str):
        import sentencepiece
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        self.kind = "pieces"
        names = (self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size()))
        self.cut = not any(SPACE in p.lstrip(SPACE) for p in names)
        self._clear()

    def _encode(self, texts: list[bytes], one_piece: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        found = self.pieces.encode([t[1:].decode("utf-8", "replace") for t in texts], num_threads=1)
        # An empty text gets no space before it, so the chunk of one space (at a text's end) has none either.
        found = [ids if t != b" " else [self.pieces.piece_to_id(SPACE)] for t, ids in zip(texts, found)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = [i for ids in found for i in ids]
        return np.array(flat, np.uint32), sizes

    def _chunks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cut = np.zeros(len(data) + 1, bool)
        if self.cut:
            cut[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20)
        cut[offsets] = True
        bounds = np.flatnonzero(cut)
        return bounds[:-1], bounds[1:], np.zeros(len(bounds) - 1, bool)


_encoders: dict[tuple[str, str], tuple[ChunkEncoder, PieceEncoder]] = {}


def encoders(file_a: str, file_b: str) -> tuple[ChunkEncoder, PieceEncoder]:
    """This worker's encoders for the two files; there are two, so each remembers fewer chunks."""
    if (file_a, file_b) not in _encoders:
        both = ChunkEncoder(file_a), PieceEncoder(file_b)
        for e in both:
            e.most = REMEMBERED
        _encoders[file_a, file_b] = both
    return _encoders[file_a, file_b]


class Spelling:
    """The bytes of all ids of a vocabulary."""

    def __init__(self, tokens: Sequence[bytes]):
        self.length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def spells(self, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each text whether its ids' bytes are its bytes."""
        edge = np.concatenate([[0], np.cumsum(counts)])
        total = np.concatenate([[0], np.cumsum(self.length[ids])])
        size = np.diff(offsets)
        good = total[edge[1:]] - total[edge[:-1]] == size
        if good.all():
            written, given, owner = self._written(ids), data, offsets
        else:
            written = self._written(ids[np.repeat(good, counts)])
            given = data[np.repeat(good, size)]
            owner = np.concatenate([[0], np.cumsum(np.where(good, size, 0))])
        wrong = np.flatnonzero(written != given)
        if len(wrong):
            good = good.copy()
            good[np.searchsorted(owner, wrong, "right") - 1] = False
        return good

    def _written(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[ragged_arange(self.start[ids], self.length[ids])]


def possible_pairs(tokens_a: Sequence[bytes], tokens_b: Sequence[bytes]) -> int:
    """How many pairs of ids there are of which one's bytes end the other's: a bound of all pairs that end together."""
    n = 0
    for first, some, others in ((0, tokens_a, tokens_b), (1, tokens_b, tokens_a)):  # equal ones count once
        held: dict[bytes, int] = {}
        for t in others:
            held[t] = held.get(t, 0) + 1
        n += sum(held.get(t[i:], 0) for t in some for i in range(first, len(t)))
    return n


# ---- Spark ----------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Files:
    """The vocabulary files of the two sides."""

    a: str
    b: str


def _wide(column) -> pa.Array:
    """The texts with a space before each; null and empty texts are empty."""
    text = pc.fill_null(column, "")
    return pc.if_else(pc.equal(pc.binary_length(text), 0), "", pc.binary_join_element_wise(" ", text, ""))


def _id_kind(spelt: Spelling) -> np.dtype:
    """Ids are written as little-endian numbers of 16 bits where the vocabulary fits, else 32."""
    return np.dtype("<u2" if len(spelt.length) <= 1 << 16 else "<u4")


def _encoded(batches: Iterator[pa.RecordBatch], files: Files, spelling) -> Iterator[pa.RecordBatch]:
    """Ids of both sides of each text; none where either does not spell the text."""
    for batch in batches:
        text, rest = _wide(batch.column("__text")), batch.drop_columns(["__text"])
        for lo, hi, data, offsets in text_slices(text, SLICE):
            some = text.slice(lo, hi - lo)
            good = np.diff(offsets) > 0
            sides = []
            for enc, spelt in zip(encoders(files.a, files.b), spelling.value):
                ids, counts = enc.encode(some)
                good = good & spelt.spells(ids, counts, data, offsets)
                sides.append((ids, counts, _id_kind(spelt)))
            columns = []
            for ids, counts, kind in sides:
                ends = kind.itemsize * np.concatenate([[0], np.cumsum(np.where(good, counts, 0))])
                raw = ids[np.repeat(good, counts)].astype(kind).tobytes()
                columns.append(pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(raw)]))
            yield pa.RecordBatch.from_arrays([*rest.slice(lo, hi - lo).columns, *columns], names=[*rest.schema.names, "__a", "__b"])


def _slices(batch: pa.RecordBatch, spelling) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids of both sides of runs of texts, and the texts' bounds in each."""
    sides = [(*string_buffers(batch.column(c)), _id_kind(spelt)) for c, spelt in zip(("__a", "__b"), spelling.value)]
    lo, n, at = 0, batch.num_rows, sides[0][1]
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + SLICE, "right")) - 1)
        out = []
        for raw, place, kind in sides:
            out += [np.frombuffer(raw[place[lo]:place[hi]].tobytes(), kind).astype(np.int64), (place[lo:hi + 1] - place[lo]) // kind.itemsize]
        yield tuple(out)
        lo = hi


def _keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b


def _pair_counts(batches: Iterator[pa.RecordBatch], spelling) -> Iterator[pa.RecordBatch]:
    """How many links hold each pair of ids linked, in one task."""
    _encoders.clear()  # a worker that encoded before needs its memory now
    length_a, length_b = (s.length for s in spelling.value)
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for a, _, b, _ in _slices(batch, spelling):
            x, y = align(length_a[a], length_b[b]).end_links()
            found, n = np.unique(_keys(a[x], b[y]), return_counts=True)
            keys, where = np.unique(np.concatenate([keys, found]), return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, where, np.concatenate([counts, n]))
            counts = total
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])


@dataclass
class PairCounts:
    """Pairs of ids, ascending, with their counts and whether a count is the highest of its second id."""

    keys: np.ndarray
    counts: np.ndarray
    best: np.ndarray


def count_pairs(encoded: DataFrame, spelling) -> PairCounts:
    """One row for each pair of ids that ends together anywhere; at most ``possible_pairs``."""
    rows = encoded.select("__a", "__b").mapInArrow(lambda it: _pair_counts(it, spelling), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    got = rows.toArrow()
    keys, counts = got["pair"].to_numpy().astype(np.int64), got["n"].to_numpy().astype(np.int64)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    b = keys & 0xFFFFFFFF
    highest = np.zeros(int(b.max()) + 1 if len(b) else 1, np.int64)
    np.maximum.at(highest, b, counts)
    return PairCounts(keys, counts, counts == highest[b])


def _sides_text(a: np.ndarray, b: np.ndarray, found: Aligned, first_a: np.ndarray, first_b: np.ndarray, names: list[str]) -> list[str]:
    """For each text ``a1,a2|b1;a3|b2``: the ids of both sides, group by group."""
    vocabulary = len(names) // 3
    group_a, group_b = found.group_a, found.group_b
    cuts = len(found.cuts)
    before_a, before_b = (np.searchsorted(g, np.arange(cuts + 1)) for g in (group_a, group_b))
    code = np.empty(len(a) + len(b), np.int64)                       # ids, plus the vocabulary's size for each kind of sign behind them
    last_a, last_b = before_a[1:] - 1, before_b[1:] - 1
    signed_a, signed_b = a.astype(np.int64), b.astype(np.int64)
    signed_a[last_a] += vocabulary
    signed_b[last_b] += 2 * vocabulary
    code[np.arange(len(a)) + before_b[group_a]] = signed_a
    code[np.arange(len(b)) + before_a[group_b + 1]] = signed_b
    parts = [names[i] for i in code.tolist()]
    edge = (first_a + first_b).tolist()
    return ["".join(parts[i:j])[:-1] for i, j in zip(edge, edge[1:])]


RESULTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _results(batches: Iterator[pa.RecordBatch], spelling, shared) -> Iterator[pa.RecordBatch]:
    length_a, length_b = (s.length for s in spelling.value)
    pairs: PairCounts = shared.value
    size = max(len(length_a), len(length_b))
    names = [f"{i}{sign}" for sign in ",|;" for i in range(size)]
    for batch in batches:
        columns: list[list] = [[] for _ in RESULTS]
        for a, first_a, b, first_b in _slices(batch, spelling):
            found = align(length_a[a], length_b[b])
            x, y = found.end_links()
            at = np.searchsorted(pairs.keys, _keys(a[x], b[y]))
            bounds = np.searchsorted(x, first_a)                     # links are ordered by the first side's token
            starts = np.concatenate([[0], found.ends_a])[first_a]
            run = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[bounds])
            for column, values in zip(columns, (np.diff(first_a), np.diff(first_b), np.diff(np.searchsorted(found.cuts, starts, "right")), np.diff(bounds),
                                                run(pairs.best[at]), run(pairs.counts[at]))):
                column.append(values)
            columns[-1] += [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in _sides_text(a, b, found, first_a, first_b, names)]
        rest = batch.drop_columns(["__a", "__b"])
        arrays = [pa.array(np.concatenate([np.zeros(0, np.int64), *c]).astype(np.int64)) for c in columns[:-1]]
        yield pa.RecordBatch.from_arrays([*rest.columns, *arrays, pa.array(columns[-1], pa.string())], names=[*rest.schema.names, *RESULTS])


def _schema(rows: DataFrame, without: Sequence[str], more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in without] + [more])


def encode_both(docs: DataFrame, files: Files, keep: Sequence[str], text: str = "text") -> tuple[DataFrame, object]:
    """The columns ``keep`` with both sides' ids in ``__a`` and ``__b``, written to the shared folder, and the shared spellings."""
    spelling = docs.sparkSession.sparkContext.broadcast((Spelling(byte_level_tokens(files.a)), Spelling(piece_tokens(files.b))))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    encoded = rows.mapInArrow(lambda it: _encoded(it, files, spelling), _schema(rows, ["__text"], "__a binary, __b binary"))
    return stored(encoded, "two-encodings"), spelling


def align_documents(docs: DataFrame, files: Files, keep: Sequence[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) and ``RESULTS``: tokens of both sides, groups, links that end together,
    those whose pair's count is its second id's highest, the sum of their counts, and a digest of the groups."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    encoded, spelling = encode_both(docs, files, keep, text)
    shared = docs.sparkSession.sparkContext.broadcast(count_pairs(encoded, spelling))
    more = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in RESULTS)
    return encoded.mapInArrow(lambda it: _results(it, spelling, shared), _schema(encoded, ["__a", "__b"], more))


_LINK_ROWS = 1 << 16


def token_links(docs: DataFrame, files: Files, keep: Sequence[str], text: str = "text", within_groups: bool = False) -> DataFrame:
    """A row for each link of each document: ``keep``, ``a`` and ``b`` (places of the tokens), ``id_a``, ``id_b``, ``bytes`` (shared), ``ends`` (together)
    and ``group``: the overlap links, or with ``within_groups`` the shared-group links (whose ``bytes`` may be 0).

    A group of m and n tokens has m times n of the latter; they are made so many tokens at a time.
    """
    encoded, spelling = encode_both(docs, files, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_a, length_b = (s.length for s in spelling.value)
        for batch in batches:
            rest = batch.drop_columns(["__a", "__b"])
            for i in range(batch.num_rows):
                for a, _, b, _ in _slices(batch.slice(i, 1), spelling):
                    found = align(length_a[a], length_b[b])
                    starts_a, starts_b = found.ends_a - length_a[a], found.ends_b - length_b[b]
                    largest = max(1, int(np.diff(np.searchsorted(found.group_b, np.arange(len(found.cuts) + 1))).max())) if len(b) else 1
                    step = max(1, _LINK_ROWS // largest) if within_groups else max(1, len(a))
                    for lo in range(0, len(a), step):
                        x, y = found.group_links(slice(lo, lo + step))[:2] if within_groups else found.overlaps()[:2]
                        common = np.maximum(np.minimum(found.ends_a[x], found.ends_b[y]) - np.maximum(starts_a[x], starts_b[y]), 0)
                        row = rest.take(pa.array(np.full(len(x), i)))
                        yield pa.RecordBatch.from_arrays(
                            [*row.columns, pa.array(x), pa.array(y), pa.array(a[x].astype(np.int64)), pa.array(b[y].astype(np.int64)), pa.array(common),
                             pa.array(found.ends_a[x] == found.ends_b[y]), pa.array(found.group_a[x])],
                            names=[*rest.schema.names, "a", "b", "id_a", "id_b", "bytes", "ends", "group"])

    return encoded.mapInArrow(run, _schema(encoded, ["__a", "__b"], "a long, b long, id_a long, id_b long, bytes long, ends boolean, `group` long"))
