"""Seeded synthetic labelled points, generated in parallel.

Each row is a pure function of ``(seed, id)``: uniforms come from the hex
digits of ``md5("<seed>:<id>:<salt>")`` (eight hex digits = one 32-bit
uniform, four per digest), normals from the Box-Muller transform.  So the
output does not depend on how ``spark.range`` is partitioned, no row pattern
repeats, and exactly ``n`` rows are made.

Shape of the data: a balanced two-class problem with three informative
features; class ``c`` is a unit normal cloud around the hypercube corner
``MEANS[c]``; 1% of the rows get a label drawn at random; a colour name and
a letter A-D as categories.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Category vocabularies and class centres of the generator.
COLOURS = ["Red", "Green", "Blue", "Yellow", "Orange", "Purple", "Pink", "Brown",
           "Black", "White", "Gray", "Cyan", "Magenta", "Olive", "Navy", "Teal",
           "Maroon", "Lime", "Silver", "Gold"]
LETTERS = ["A", "B", "C", "D"]
MEANS = {0: (-1.0, -1.0, 1.0), 1: (1.0, 1.0, -1.0)}
FLIP_FRACTION = 0.01


def _digest(seed: int, id_col: Column, salt: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), id_col.cast("string"), F.lit(f":{salt}")))


def _uniform(digest: Column, j: int) -> Column:
    """j-th 32-bit uniform (j in 0..3) of a digest, in the open interval (0, 1)."""
    word = F.conv(F.substring(digest, 8 * j + 1, 8), 16, 10).cast("bigint")
    return (word.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)


def points_for_ids(ids: DataFrame, seed: int = 42, id_col: str = "id", partitions: int | None = None) -> DataFrame:
    """Synthetic point for every row of ``ids`` (a DataFrame with a bigint id).

    ``partitions``: spread the ids over so many tasks first; making a point costs far more than
    moving an id, so a table of few files would leave cores idle."""
    i = F.col(id_col)
    if partitions:
        ids = ids.select(i).repartition(partitions)
    d = [_digest(seed, i, s) for s in ("a", "b", "c")]
    u = [_uniform(d[k // 4], k % 4) for k in range(12)]
    base = ids.select(i.alias("id"), *[x.alias(f"_u{k}") for k, x in enumerate(u)])
    U = [F.col(f"_u{k}") for k in range(12)]
    cls = F.when(U[0] < 0.5, 1).otherwise(0)
    label = F.when(U[1] < FLIP_FRACTION, F.when(U[2] < 0.5, 1).otherwise(0)).otherwise(cls)
    r1, r2 = F.sqrt(-2.0 * F.log(U[3])), F.sqrt(-2.0 * F.log(U[5]))
    z = [r1 * F.cos(2 * math.pi * U[4]), r1 * F.sin(2 * math.pi * U[4]), r2 * F.cos(2 * math.pi * U[6])]
    feats = [F.when(cls == 1, MEANS[1][k]).otherwise(MEANS[0][k]) + z[k] for k in range(3)]
    colours = F.array(*[F.lit(c) for c in COLOURS])
    letters = F.array(*[F.lit(c) for c in LETTERS])
    pick = lambda arr, n, x: F.element_at(arr, (F.floor(x * n) + 1).cast("int"))
    return base.select(
        "id",
        feats[0].alias("num_feature_1"), feats[1].alias("num_feature_2"), feats[2].alias("num_feature_3"),
        pick(colours, len(COLOURS), U[7]).alias("category_1"),
        pick(letters, len(LETTERS), U[8]).alias("category_2"),
        label.cast("int").alias("label"),
    )


def generate_points(spark: SparkSession, n: int, seed: int = 42,
                    num_partitions: int | None = None) -> DataFrame:
    """Exactly ``n`` synthetic points, ids ``0..n-1``."""
    return points_for_ids(spark.range(0, n, 1, num_partitions), seed)
