"""Parquet test tables and the two views that stand in for the workloads'
inputs: the points view ``P`` and the part co-order graph ``E``.

Both views are lazy DataFrames; Catalyst prunes the parquet scans to the
columns used (``ReadSchema``) and plans the joins.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import hotkeys
from lodestar.session import freed_shuffles

FEATURES = ["num_feature_1", "num_feature_2", "num_feature_3"]
# Four columns that identify a points row (unique at sf0.01 and sf0.1).
POINT_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table, ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def points_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points view ``P``: a points table (three numeric features, two
    categories, a 0/1 label) over ``lineitem JOIN orders``.

    The label ``quantity * (1 - discount) > 23`` is learnable from the
    features.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        li.l_orderkey, li.l_linenumber, li.l_partkey, li.l_suppkey,
        li.l_quantity.alias("num_feature_1"),
        li.l_discount.alias("num_feature_2"),
        li.l_tax.alias("num_feature_3"),
        o.o_orderpriority.alias("category_1"),
        li.l_returnflag.alias("category_2"),
        (li.l_quantity * (1 - li.l_discount) > 23).cast("int").alias("label"),
    )


HOT_ORDER_PARTS = 5_000   # an order with more lines than this is salted
TASK_ROWS = 500_000       # lines, or pairs, that a task sorts or makes distinct


def part_graph(spark: SparkSession, sf_dir: str, hot_parts: int = HOT_ORDER_PARTS,
               max_hot: int = hotkeys.MAX_HOT) -> DataFrame:
    """Part co-order graph ``E(a, b)``: parts bought in the same order,
    one row per unordered pair, ``a < b``.

    (order, part) pairs are de-duplicated before the self-join so a part
    repeated inside an order does not multiply the pairs.  The output of an
    order with ``P`` parts is ``P(P-1)/2`` pairs whatever the plan; what the
    plan decides is how that work is spread.  Orders with more than
    ``hot_parts`` lines (at most ``max_hot`` of them, or else the threshold
    rises, see :mod:`lodestar.functions.hotkeys`) are salted: one side is split into ``S = ceil(P /
    hot_parts)`` groups by a hash of the part, the other side is repeated
    ``S`` times, so each task makes at most about ``P * hot_parts`` pairs.
    Other orders have one group.

    The lines are shuffled once, by order, for both the distinct and the
    self-join, and the pairs once.  Both go to as many tasks as keep one at
    about ``TASK_ROWS`` rows: the counts of the lines tell how many there are.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    # Lines per order bound its distinct parts from above, and need no
    # distinct: one aggregate with map-side combine.
    sizes = lines.where("l_orderkey is not null").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("p"))
    p = F.col("p").cast("double")
    with freed_shuffles(spark):
        t, (n_hot, n, pairs) = hot_parts, sizes.agg(F.count_if(F.col("p") > hot_parts), F.coalesce(F.sum(p), F.lit(0.0)),
                                                    F.coalesce(F.sum(p * (p - 1) / 2), F.lit(0.0))).first()
    if n_hot > max_hot:
        t, n_hot = hotkeys.threshold(sizes, "p", hot_parts, max_hot)
    pair_tasks = _tasks(pairs)
    if not n_hot:
        li = lines.where("l_orderkey is not null").repartition(_tasks(n), "l_orderkey").distinct()
        return _pairs(li, li, pair_tasks)
    li = lines.distinct()
    split = hotkeys.salts(sizes.filter(F.col("p") > t), "l_orderkey", "p", t, "l_orderkey")
    li = li.join(split, "l_orderkey", "left")
    return _pairs(li.select("l_orderkey", "l_partkey", hotkeys.salt_of(F.col("l_partkey")).alias("salt")),
                  li.select("l_orderkey", "l_partkey", hotkeys.all_salts().alias("salt")), pair_tasks, ["salt"])


def _tasks(rows: float) -> int:
    return min(1 << 20, max(1, math.ceil(rows / TASK_ROWS)))


def _pairs(x: DataFrame, y: DataFrame, tasks: int, extra: list[str] | None = None) -> DataFrame:
    x, y = x.alias("x"), y.alias("y")
    cond = (F.col("x.l_orderkey") == F.col("y.l_orderkey")) & (F.col("x.l_partkey") < F.col("y.l_partkey"))
    for c in extra or []:
        cond = cond & (F.col(f"x.{c}") == F.col(f"y.{c}"))
    return x.join(y, cond).select(F.col("x.l_partkey").alias("a"), F.col("y.l_partkey").alias("b")).repartition(tasks, "a", "b").distinct()


def messy_part_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``E`` as a raw directed edge list ``(src, dst)``: every edge in both
    directions, each once more as a duplicate, plus a self-loop on every
    vertex.  Canonicalising it must give back ``E``."""
    a, b = F.col("a"), F.col("b")
    ends = [F.struct(x.alias("src"), y.alias("dst")) for x, y in ((a, b), (b, a), (a, b), (a, a))]
    return part_graph(spark, sf_dir).select(F.inline(F.array(*ends)))  # one pass: a union would make the pairs distinct four times


def raw_string_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A string edge table ``(u, v)`` derived from ``lineitem``, the shape an
    edge file has before the cast: ``u`` from the part key, ``v`` from the
    supplier key.  Faults come from the data itself: returned lines (flag
    ``R``) carry the flag after the part id, so ``u`` is not an integer;
    open lines with flag ``N`` move ``v`` past 2^32, beyond a 32-bit int.
    """
    li = table(spark, sf_dir, "lineitem")
    u = F.when(F.col("l_returnflag") == "R",
               F.concat(F.col("l_partkey").cast("string"), F.col("l_returnflag"))) \
        .otherwise(F.col("l_partkey").cast("string"))
    v = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"),
               (F.col("l_suppkey") + F.lit(3000000000)).cast("string")) \
        .otherwise(F.col("l_suppkey").cast("string"))
    return li.select(u.alias("u"), v.alias("v"))
