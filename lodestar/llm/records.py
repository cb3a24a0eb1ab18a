"""Token ids as length-delimited binary records, with an offset index.

File format (all numbers little-endian).  A data file is a run of frames::

    length   8 bytes   bytes in the payload
    check    4 bytes   masked checksum of the 8 length bytes
    payload            one serialized document
    check    4 bytes   masked checksum of the payload

The masked checksum of ``c = crc32(bytes)`` is ``((c >> 15 | c << 17) +
0xa282ead8) mod 2**32``.  A payload is 1 byte (1: the document has an id, 0:
null), 8 bytes of doc_id, 1 byte for the width of an id (2 or 4 bytes; 2 where
the vocabulary fits) and the ids.  The index is a table beside the data with
one row per frame (file, part, offset, size, number of ids, ids before it in
its file), so frames can be read in any order.

Documents are dealt into ranges of ascending doc_id by Spark, one data file
for each range.  A task writes a file under a name of its own and reports it
in its index rows; rows of failed attempts never reach the index, so their
files are never read.  Files go to the given shared folder through Arrow's
file systems (a mounted path, ``hdfs://``, ``s3://`` ...).

Defined results: null and empty texts are the end id alone; rows with a null
doc_id come first; rows with the same id stand in order of their text; an
empty table writes no file and gives no row.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm.encoding import append_end, encoder
from lodestar.session import shared_dir

INDEX = "file string, part long, doc_id long, offset long, size long, n_tokens long, start_in_file long"
FLUSH_BYTES = READ_BYTES = 8 << 20
_HEAD = struct.Struct("<QI")
_TAIL = struct.Struct("<I")
_DOC = struct.Struct("<BqB")


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join([size, _TAIL.pack(masked(size)), payload, _TAIL.pack(masked(payload))])


def read_frame(data: memoryview, at: int) -> tuple[memoryview, int]:
    """The payload at ``at`` and where the next frame begins; ``ValueError`` for a damaged frame."""
    if at + _HEAD.size > len(data):
        raise ValueError(f"frame at {at}: cut short")
    size, check = _HEAD.unpack_from(data, at)
    if check != masked(data[at:at + 8]):
        raise ValueError(f"frame at {at}: the length is damaged")
    begin, end = at + _HEAD.size, at + _HEAD.size + size
    if end + _TAIL.size > len(data):
        raise ValueError(f"frame at {at}: cut short")
    if _TAIL.unpack_from(data, end)[0] != masked(data[begin:end]):
        raise ValueError(f"frame at {at}: the payload is damaged")
    return data[begin:end], end + _TAIL.size


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path)


def _write_partition(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int, width: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    name = f"{folder}/ids-{part:06d}-{uuid.uuid4().hex[:12]}.bin"
    out, at, before, waiting = None, 0, 0, bytearray()
    for batch in batches:
        if not batch.num_rows:
            continue
        if out is None:
            store, where = _open(name)
            store.create_dir(where.rpartition("/")[0], recursive=True)
            out = store.open_output_stream(where)
        ids, counts = append_end(*encoder(path).encode(batch.column(1)), end_id)
        raw = memoryview(ids.astype(f"<u{width}").tobytes())
        offsets, sizes, starts, end = [], [], [], 0
        for doc_id, n in zip(batch.column(0).to_pylist(), counts.tolist()):
            record = frame(_DOC.pack(doc_id is not None, doc_id or 0, width) + raw[width * end:width * (end + n)])
            offsets.append(at)
            sizes.append(len(record))
            starts.append(before)
            waiting += record
            at, before, end = at + len(record), before + n, end + n
            if len(waiting) >= FLUSH_BYTES:
                out.write(bytes(waiting))
                waiting.clear()
        k = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * k), pa.array([part] * k, pa.int64()), batch.column(0), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64()),
             pa.array(counts, pa.int64()), pa.array(starts, pa.int64())],
            names=["file", "part", "doc_id", "offset", "size", "n_tokens", "start_in_file"])
    if out is not None:
        out.write(bytes(waiting))
        out.close()


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` to ``folder`` (frames under ``data``, the index under ``index``) and return the index as read back."""
    from tokenizers import Tokenizer
    width = 2 if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    # The start of the text too, so that rows of one id (or without one) are not one task's; it orders them as the text does.
    rows = rows.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    index = rows.mapInArrow(lambda it: _write_partition(it, f"{folder}/data", tokenizer_path, end_id, width), INDEX)
    index.write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _read_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files, offsets, sizes = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        got: list[tuple] = []
        i, n, source, name = 0, batch.num_rows, None, None
        while i < n:
            if files[i] != name:
                if source is not None:
                    source.close()
                name = files[i]
                store, where = _open(name)
                source = store.open_input_file(where)
            j = i + 1  # frames that follow each other in the file are read together
            while j < n and files[j] == name and offsets[j] == offsets[j - 1] + sizes[j - 1] and offsets[j] + sizes[j] - offsets[i] <= READ_BYTES:
                j += 1
            source.seek(int(offsets[i]))
            data, at = memoryview(source.read(int(offsets[j - 1] + sizes[j - 1] - offsets[i]))), 0
            for _ in range(i, j):
                payload, at = read_frame(data, at)
                has, doc, width = _DOC.unpack_from(payload, 0)
                ids = np.frombuffer(payload[_DOC.size:], f"<u{width}").astype("<u4")
                got.append((doc if has else None, len(ids), zlib.crc32(ids.tobytes())))
            i = j
        if source is not None:
            source.close()
        cols = list(zip(*got)) if got else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), batch.column(3), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_records(index: DataFrame) -> DataFrame:
    """Per record, from the data files: doc_id, start (ids in all records before it), n_tokens and ids_crc32."""
    files = index.groupBy("file").agg(F.min("part").alias("part"), F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = files.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    rows = index.join(files, "file").select("file", "offset", "size", (F.col("base") + F.col("start_in_file")).alias("start"))
    return rows.mapInArrow(_read_partition, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_records(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write, then read back every record."""
    return read_records(write_records(docs, folder or shared_dir(spark, "token-records"), tokenizer_path, end_id))
