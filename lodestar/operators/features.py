"""Feature operators: derive + filter, column statistics, standardization.

Everything here is column expressions and one small aggregate; the
statistics that a scaler needs (2 numbers per column) are the only values
brought to the driver, and they go back into the plan as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.exact import exact_sums
from lodestar.sources.tables import FEATURES


def derive_and_filter(df: DataFrame, min_new_feature: float = 11.0,
                      max_f2_plus_f3: float = 0.2, drop_nan: bool = True) -> DataFrame:
    """Add ``new_feature = num_feature_1 + length(category_1)`` and keep rows
    with ``new_feature > min_new_feature AND num_feature_2 + num_feature_3 <
    max_f2_plus_f3``.

    Null in any of the used columns drops the row (SQL three-valued logic).
    NaN would compare *greater* than every number in Spark, so with
    ``drop_nan`` a NaN feature drops the row as well, as a pandas mask does.
    """
    f1, f2, f3 = (F.col(c) for c in FEATURES)
    out = df.withColumn("new_feature", f1 + F.length("category_1"))
    cond = (F.col("new_feature") > F.lit(float(min_new_feature))) & \
           (f2 + f3 < F.lit(float(max_f2_plus_f3)))
    if drop_nan:
        cond = cond & ~F.isnan(f1) & ~F.isnan(f2) & ~F.isnan(f3)
    return out.filter(cond)


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: ``column, n, mean, std_samp, std_pop`` (nulls
    ignored, as SQL aggregates do).  One aggregate pass; the wide result is
    unpivoted with ``stack`` so the output has a fixed schema."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__ss"), F.stddev_pop(c).alias(f"{c}__sp")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', `{c}__n`, `{c}__mean`, `{c}__ss`, `{c}__sp`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {parts}) AS (column, n, mean, std_samp, std_pop)")


def exact_column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """As :func:`column_stats`, from sums without rounding (:mod:`lodestar.functions.exact`): bit for bit
    the same however the rows are ordered and partitioned.  A column with an infinite or NaN value has NaN statistics."""
    sums = exact_sums(df, cols)
    rows = [(c, s.n, s.mean, s.std(1), s.std(0)) for c, s in sums.items()]
    return df.sparkSession.createDataFrame(rows, "column STRING, n BIGINT, mean DOUBLE, std_samp DOUBLE, std_pop DOUBLE")


def significant(x: float | None, digits: int) -> float | None:
    """``x`` at so many significant digits, whatever its magnitude."""
    return None if x is None else float(f"{x:.{digits - 1}e}")


def fit_standardizer(df: DataFrame, cols: Sequence[str], ddof: int = 1,
                     digits: int | None = None, exact: bool = False) -> list[tuple[float, float]]:
    """Mean and standard deviation (``ddof`` 1 = sample, 0 = population) of
    each column, from one aggregate job; returns ``[(mean, std), ...]``.

    Floating sums differ in their last bits with the order of the rows.
    ``digits`` keeps that many significant digits of each statistic (12 are
    well above those bits), so algorithms with discontinuous steps, such as
    nearest-center ties, take the same steps on every partitioning.  ``exact`` sums without
    rounding (:mod:`lodestar.functions.exact`), so no digit differs, at the price of a row per value in the aggregate."""
    if ddof not in (0, 1):
        raise ValueError("ddof must be 0 or 1")
    if exact:
        return [(s.mean, s.std(ddof)) for s in exact_sums(df, cols).values()]
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    row = df.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (("m", F.avg), ("s", std))]).first()
    stats = [(row[f"m{i}"], row[f"s{i}"]) for i in range(len(cols))]
    return stats if digits is None else [(significant(m, digits), significant(s, digits)) for m, s in stats]


def apply_standardizer(df: DataFrame, cols: Sequence[str], stats: Sequence[tuple[float, float]],
                       with_mean: bool = True, with_std: bool = True,
                       suffix: str = "") -> DataFrame:
    """Replace (or, with ``suffix``, add) each column by its standardized
    value.  A zero or undefined standard deviation gives 0.0 for that column,
    as MLlib's scaler does, instead of a division error under ANSI mode."""
    exprs = {}
    for c, (mean, std) in zip(cols, stats):
        x = F.col(c)
        if with_mean:
            x = x - F.lit(float(mean if mean is not None else 0.0))
        if with_std:
            if std is None or std == 0.0:
                x = F.lit(0.0)
            else:
                x = x / F.lit(float(std))
        exprs[c + suffix] = x.cast("double")
    return df.withColumns(exprs)


def standardize(df: DataFrame, cols: Sequence[str], with_mean: bool = True,
                with_std: bool = True, ddof: int = 0, suffix: str = "",
                digits: int | None = None, exact: bool = False) -> DataFrame:
    """Standardize named double columns: one aggregate job for the
    statistics, then one ``select`` with them as literals."""
    stats = fit_standardizer(df, cols, ddof, digits, exact)
    return apply_standardizer(df, cols, stats, with_mean, with_std, suffix)


def scaler_pipeline(cols: Sequence[str], with_mean: bool, with_std: bool = True,
                    raw_col: str = "raw_features", out_col: str = "features",
                    handle_invalid: str = "error") -> Pipeline:
    """MLlib assembler + scaler (sample standard deviation)."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(cols), outputCol=raw_col, handleInvalid=handle_invalid),
        StandardScaler(inputCol=raw_col, outputCol=out_col, withMean=with_mean, withStd=with_std),
    ])


def unpack_vector(df: DataFrame, vec_col: str, names: Sequence[str]) -> DataFrame:
    """Expand an ML vector column into named double columns."""
    arr = vector_to_array(F.col(vec_col))
    return df.withColumns({n: arr[i] for i, n in enumerate(names)}).drop(vec_col)


def mllib_standardize(df: DataFrame, cols: Sequence[str], with_mean: bool = True,
                      handle_invalid: str = "error") -> DataFrame:
    """Standardize through MLlib (``VectorAssembler`` + ``StandardScaler``,
    sample std); the scaled values replace the named columns."""
    model = scaler_pipeline(cols, with_mean, handle_invalid=handle_invalid).fit(df)
    out = model.transform(df).drop(*cols, "raw_features")
    return unpack_vector(out, "features", cols)
