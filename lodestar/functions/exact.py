"""Sums of doubles that do not hang on the order of the rows.

Every finite double is a whole number times a power of two.  Values are put into bins by their exponent;
within a bin all are whole multiples of one power of two, below 2^56.  Spark adds their upper and lower
halves as two whole numbers of 64 bits, which the rows of one partition cannot overflow, and the sums of the
partitions as decimals, so nothing is rounded, in any order.  Squares are added as three sums of
products of the values' upper and lower halves.  A column has at most some two thousand
bins, so the sums of the bins come to the driver, where mean and deviations are worked
out in rational numbers and rounded once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HALF = 28                      # bits of the lower half
_UNITS = 1 << HALF


def _scale_down(x: Column, power: Column) -> Column:
    """``x * 2**-power`` without rounding: in two steps, so that no power overflows."""
    first = F.floor(power / 2).cast("int")
    two = F.lit(2.0)
    return x * F.pow(two, -first.cast("double")) * F.pow(two, (first - power).cast("double"))


def _bin(x: Column) -> Column:
    """The exponent of the unit of a value's bin: about 2^54 units make the value, and no value has a part of a unit."""
    exponent = F.floor(F.log2(F.abs(x))).cast("int") - 54
    return F.when(x == 0, F.lit(-1074)).otherwise(F.greatest(exponent, F.lit(-1074)))


@dataclass
class ExactSums:
    """Count, sum and sum of squares of a column's finite values; ``others``: the values that are infinite or NaN."""

    n: int = 0
    total: Fraction = Fraction(0)
    squares: Fraction = Fraction(0)
    others: int = 0

    @property
    def mean(self) -> float | None:
        return None if not self.n else math.nan if self.others else _rounded(self.total / self.n)

    def std(self, ddof: int) -> float | None:
        """Standard deviation, ``ddof`` 1 for the sample, 0 for the population; None without enough values."""
        if self.n <= ddof:
            return None
        if self.others:
            return math.nan
        return _root((self.squares - self.total * self.total / self.n) / (self.n - ddof))


def _rounded(x: Fraction) -> float:
    return x.numerator / x.denominator  # whole numbers divide with one rounding


def _root(x: Fraction) -> float:
    """The square root, from a whole root with 64 digits to spare."""
    if x <= 0:
        return 0.0
    shift = max(0, 2 * ((x.denominator.bit_length() - x.numerator.bit_length()) // 2 + 80))
    root = math.isqrt((x.numerator << shift) // x.denominator)
    return _rounded(Fraction(root, 1 << (shift // 2)))


def exact_sums(df: DataFrame, cols: Sequence[str]) -> dict[str, ExactSums]:
    """Sums of each column (nulls ignored), from one aggregate; equal for equal rows however they are partitioned."""
    values = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(cols)])).alias("v")) \
        .select("v.c", "v.x").where("x is not null")
    finite = ~F.isnan("x") & (F.abs("x") != math.inf)
    binned = values.select("c", "x", F.when(finite, _bin(F.col("x"))).alias("bin"))
    units = F.when(F.col("bin").isNotNull(), _scale_down(F.col("x"), F.col("bin")).cast("bigint"))
    halves = binned.select("c", "bin", units.alias("q")).withColumns({"hi": F.shiftright("q", HALF), "lo": F.col("q").bitwiseAND(_UNITS - 1)})
    q, hi, lo = F.col("q"), F.col("hi"), F.col("lo")
    sums = {"q": q, "hh": hi * hi, "hl": hi * lo, "ll": lo * lo}
    limbs = [F.sum(part).alias(f"{k}{i}") for k, x in sums.items() for i, part in enumerate((F.shiftright(x, HALF), x.bitwiseAND(_UNITS - 1)))]
    parts = halves.groupBy("c", "bin", F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"), *limbs)
    whole = [F.sum(F.col(f"{k}{i}").cast("decimal(20,0)")).alias(f"{k}{i}") for k in sums for i in (0, 1)]
    rows = parts.groupBy("c", "bin").agg(F.sum("n").alias("n"), *whole).collect()
    of = lambda r, k: int(r[f"{k}0"]) * _UNITS + int(r[f"{k}1"])
    out = {c: ExactSums() for c in cols}
    for r in rows:
        s = out[cols[r["c"]]]
        s.n += r["n"]
        if r["bin"] is None:
            s.others += r["n"]
            continue
        unit = Fraction(2) ** r["bin"]
        s.total += of(r, "q") * unit
        s.squares += (of(r, "hh") * _UNITS * _UNITS + 2 * of(r, "hl") * _UNITS + of(r, "ll")) * unit * unit
    return out
