"""Distance and nearest-center column expressions (no UDF).

For the few features and centers k-means uses, the distance to every center
is unrolled into plain arithmetic, which whole-stage codegen compiles into
the scan loop; array higher-order functions are offered for array columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(cols: Sequence[str | Column], center: Sequence[float]) -> Column:
    """``sum_i (x_i - c_i) * (x_i - c_i)`` over named columns and a literal
    center, summed left to right (the order an SQL oracle uses too)."""
    terms = []
    for c, v in zip(cols, center):
        x = F.col(c) if isinstance(c, str) else c
        d = x - F.lit(float(v))
        terms.append(d * d)
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def nearest_center(cols: Sequence[str | Column] | str, centers: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest center; on a tie the lowest index wins.  ``cols``:
    the feature columns, or the name of one array column.

    ``array_min`` then ``array_position`` (first match) gives exactly that
    rule, in one expression per row.
    """
    if len(centers) == 1:
        return F.lit(0)
    one = array_squared_distance if isinstance(cols, str) else squared_distance
    d = F.array(*[one(cols, c) for c in centers])
    return (F.array_position(d, F.array_min(d)) - 1).cast("int")


def array_squared_distance(vec: str | Column, center: Sequence[float]) -> Column:
    """Squared distance of an ``array<double>`` column to a literal center,
    for wide vectors where unrolling would make large plans."""
    v = F.col(vec) if isinstance(vec, str) else vec
    c = F.array(*[F.lit(float(x)) for x in center])
    diffs = F.zip_with(v, c, lambda a, b: (a - b) * (a - b))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def allclose(a: Sequence[Sequence[float]], b: Sequence[Sequence[float]],
             rtol: float = 1e-5, atol: float = 1e-8) -> bool:
    """Element-wise ``|a - b| <= atol + rtol * |b|`` over two small center
    lists held on the driver (k x d numbers)."""
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if not abs(x - y) <= atol + rtol * abs(y):
                return False
    return True
