"""Edge files: delimited text with a header line (``u v``), read as strings
and cast to 64-bit ids.

``on_bad`` decides what a non-integer id does: ``"raise"`` uses a plain cast
(ANSI mode fails the job on the first bad value), ``"drop"`` uses
``try_cast`` and drops the row, ``"null"`` keeps it with a null id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRINGS = T.StructType([T.StructField("u", T.StringType()), T.StructField("v", T.StringType())])


def cast_edges(raw: DataFrame, u: str = "u", v: str = "v", on_bad: str = "raise",
               src: str = "src", dst: str = "dst") -> DataFrame:
    """String endpoints ``u, v`` -> ``src, dst`` bigint."""
    if on_bad == "raise":
        return raw.select(F.trim(F.col(u)).cast("bigint").alias(src),
                          F.trim(F.col(v)).cast("bigint").alias(dst))
    if on_bad not in ("drop", "null"):
        raise ValueError("on_bad must be 'raise', 'drop' or 'null'")
    out = raw.select(F.expr(f"try_cast(trim(`{u}`) AS BIGINT)").alias(src),
                     F.expr(f"try_cast(trim(`{v}`) AS BIGINT)").alias(dst))
    if on_bad == "drop":
        out = out.filter(F.col(src).isNotNull() & F.col(dst).isNotNull())
    return out


def read_edges(spark: SparkSession, path: str, sep: str = " ", header: bool = True,
               on_bad: str = "raise") -> DataFrame:
    """Delimited edge file -> ``(src, dst)`` bigint.

    The separator is a parameter (tab for some public graph dumps, space for
    others).  Columns are taken by position, whatever the header says; the
    header line of every file is skipped by the reader.
    """
    raw = spark.read.option("header", header).option("sep", sep).schema(_STRINGS).csv(path)
    return cast_edges(raw, on_bad=on_bad)


def read_edge_list(spark: SparkSession, path: str, header: bool = True,
                   on_bad: str = "raise", comment: str | None = "#") -> DataFrame:
    """Edge list whose two ids are separated by any run of blanks or tabs ->
    ``(src, dst)``.

    Whole lines are read through the CSV reader (with a separator and quote
    that never occur), so ``header`` drops the first line of each file even
    when files are split across tasks; lines are then split on whitespace.
    Blank lines and lines starting with ``comment`` are skipped.  A line with
    one id has a null second end, which ``on_bad="drop"`` drops and the other
    modes keep; ids after the second are ignored.
    """
    lines = (spark.read.option("header", header).option("sep", "\u0001").option("quote", "\u0000")
             .schema("line STRING").csv(path))
    body = F.trim(F.col("line"))
    lines = lines.filter(F.col("line").isNotNull() & (F.length(body) > 0))
    if comment:
        lines = lines.filter(~body.startswith(comment))
    t = F.split(body, r"\s+")
    return cast_edges(lines.select(F.get(t, 0).alias("u"), F.get(t, 1).alias("v")), on_bad=on_bad)


def write_edge_list(edges: DataFrame, path: str, src: str = "src", dst: str = "dst",
                    sep: str = " ", header: str | None = "u v", mode: str = "errorifexists") -> None:
    """Write one ``src<sep>dst`` line per edge; each part file starts with
    ``header`` when it is given."""
    name = header or "line"
    body = edges.select(F.concat_ws(sep, F.col(src).cast("string"), F.col(dst).cast("string")).alias(name))
    (body.write.mode(mode).option("header", bool(header)).option("sep", "\u0001")
     .option("quote", "\u0000").csv(path))
