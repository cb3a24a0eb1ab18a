"""Reproducible hash expressions (pure functions of a row's key, so the
same on every partitioning and in any SQL engine that has md5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_string(key: Sequence[str]) -> Column:
    """``k1|k2|...`` of the key columns cast to string."""
    return F.concat_ws("|", *[F.col(k).cast("string") for k in key])


def hash_bucket(key: Sequence[str], buckets: int = 100) -> Column:
    """First 8 hex digits of ``md5(k1|k2|...)`` as an unsigned 32-bit
    integer, modulo ``buckets``."""
    h = F.conv(F.substring(F.md5(key_string(key)), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(buckets)).cast("int")


def uniform(key: Sequence[str], seed: int, salt: str) -> Column:
    """A number in (0, 1) that only the row's key, the seed and the salt decide: the
    first 32 bits of ``md5("seed:salt:k1|k2|...")``, in the middle of their interval."""
    text = F.concat(F.lit(f"{seed}:{salt}:"), key_string(key))
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint").cast("double")
    return (bits + F.lit(0.5)) / F.lit(4294967296.0)
