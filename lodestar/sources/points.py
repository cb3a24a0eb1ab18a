"""Points CSV: read with a fixed schema (no inference pass), or inferred;
write with one header per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed column layout of a points file (CSV binds a schema by position).
POINTS_SCHEMA = T.StructType([
    T.StructField("num_feature_1", T.DoubleType(), True),
    T.StructField("num_feature_2", T.DoubleType(), True),
    T.StructField("num_feature_3", T.DoubleType(), True),
    T.StructField("category_1", T.StringType(), True),
    T.StructField("category_2", T.StringType(), True),
    T.StructField("label", T.IntegerType(), True),
])


def read_points(spark: SparkSession, path: str, schema: T.StructType | None = POINTS_SCHEMA,
                header: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """Read a points CSV.

    With the fixed schema (default) there is no inference job and a value
    that does not parse becomes null (``PERMISSIVE``) or fails the read
    (``FAILFAST``).  ``schema=None`` infers types with an extra pass over the
    data, as a quick exploratory read would.
    """
    r = spark.read.option("header", header).option("mode", mode)
    if schema is None:
        return r.option("inferSchema", True).csv(path)
    return r.schema(schema).csv(path)


def write_points(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write points as CSV with a header line in every part file."""
    df.write.mode(mode).option("header", True).csv(path)
