"""Connected components of a table of links, by contraction.

In every round each node moves to the first of itself and its neighbours, in
the order of a hash; links are rewritten to where their ends moved, and links
within one node vanish.  Stars are gone after two rounds, and since the order
is random, chains shrink by a factor a round.  Rounds are Spark joins; each
round's table is written to the shared folder, so no lineage grows, and only
whether links are left comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.session import shared_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ranked(node: str):
    return F.struct(F.xxhash64(node).alias("h"), F.col(node).alias("n"))


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node in a link; ``links`` has two columns of one type, in any order and number.

    ``component`` is one of the component's nodes.  Null ends and links of a node
    with itself are ignored; no link gives no row.
    """
    edges = links.toDF("a", "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stored(edges.distinct(), "links")
    out = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).where("false")
    first = True
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = both.groupBy("a").agg(F.min(_ranked("b")).alias("best")) \
            .select(F.col("a").alias("node"), F.least("best", _ranked("a"))["n"].alias("to"))
        move = stored(move, "moves")
        out = move.toDF("node", "component") if first else out.join(move.toDF("component", "next"), "component", "left") \
            .select("node", F.coalesce("next", "component").alias("component"))
        first = False
        moved = edges.join(move.toDF("a", "to_a"), "a").join(move.toDF("b", "to_b"), "b").where("to_a <> to_b")
        edges = stored(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
    return out
