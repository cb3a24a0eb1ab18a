"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each over the whole test tables (or data Spark derives from
them).  ``lodestar.plans.oracle`` holds the matching SQL.

Floating outputs are rounded to 6 decimals, on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import bagging, classify, clustering, features, graph, seeding, split, vectors
from lodestar.plans import jobs
from lodestar.session import scratch, shared_dir, write_parquet
from lodestar.sources import edges as edge_io
from lodestar.sources import points as point_io
from lodestar.sources.synth import points_for_ids
from lodestar.sources.tables import (FEATURES, POINT_KEY, messy_part_edges, part_graph,
                                     points_view, raw_string_edges, table)

# Fixed values used by the queries (mirrored in the oracle SQL).
FILTER_MIN_NEW_FEATURE = 11.0
FILTER_MAX_F2_F3 = 0.1          # the test tables' discount + tax never reach 0.2
FILTER_MAX_F2_F3_ORIGINAL = 0.2
FIXED_CENTERS = [(20.0, 0.05, 0.04), (30.0, 0.05, 0.04), (45.0, 0.0, 0.08)]
EMPTY_CLUSTER_CENTERS = [(10.0, 0.02, 0.02), (40.0, 0.08, 0.06), (1000.0, 1000.0, 1000.0)]
LLOYD_K, LLOYD_ITERS, LLOYD_DIGITS = 2, 3, 12
TINY, SHIFT = 1e-6, 1e9
MANY_CENTERS, VECTOR_K = 200, 4
CONVERGE_ITERS, CONVERGE_INIT = 25, [[1.0], [200.0]]
ARRAY_CENTERS = [[0.2 if i % 3 == j else -0.1 for i in range(64)] for j in range(3)]
SMALL_TASK = 50_000             # edges of a colour task in triangle_counts_colours
SUBSET_MAX_SIZE = 10            # triangle_counts_subset: parts with p_size <= 10
FOREST_FEATURES = [*FEATURES, "new_feature"]
BAG_SEED, BAG_RATE, BAG_BINS = 42, 0.8, 32

Query = Callable[[SparkSession, str], DataFrame]


def _r(c: str, name: str | None = None):
    return F.round(F.col(c), 6).alias(name or c)


# ---- points: projection, derive + filter, aggregates ------------------------

def points_project(spark, sf):
    return points_view(spark, sf).select(*POINT_KEY, *FEATURES, "label")


def _derive_filter(spark, sf, max_f2_f3):
    df = features.derive_and_filter(points_view(spark, sf), FILTER_MIN_NEW_FEATURE, max_f2_f3)
    return df.select(*POINT_KEY, *FEATURES, "new_feature", "category_1", "label")


def points_derive_filter(spark, sf):
    return _derive_filter(spark, sf, FILTER_MAX_F2_F3)


def points_derive_filter_original(spark, sf):
    return _derive_filter(spark, sf, FILTER_MAX_F2_F3_ORIGINAL)


def label_counts(spark, sf):
    return points_view(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("label")


def column_stats(spark, sf):
    s = features.column_stats(points_view(spark, sf), FEATURES)
    return s.select("column", "n", F.round("mean", 9).alias("mean"), _r("std_samp"), _r("std_pop"))


def column_stats_magnitudes(spark, sf):
    """A feature scaled by 1e-6 (statistics in millionths) and one shifted by 1e9."""
    df = points_view(spark, sf).select((F.col(FEATURES[0]) * TINY).alias("tiny"), (F.col(FEATURES[0]) + SHIFT).alias("shifted"))
    unit = F.when(F.col("column") == "tiny", TINY).otherwise(1.0)
    s = features.column_stats(df, ["tiny", "shifted"])
    return s.select("column", "n", *[F.round(F.col(c) / unit, 4).alias(c) for c in ("mean", "std_samp", "std_pop")])


def column_stats_exact(spark, sf):
    """Sums without rounding, of features at three magnitudes: not rounded for the comparison but to a relative 1e-12."""
    f = [F.col(c) for c in FEATURES]
    df = points_view(spark, sf).select(f[0].alias("plain"), (f[0] * TINY).alias("tiny"), (f[1] * SHIFT).alias("large"))
    s = features.exact_column_stats(df, ["plain", "tiny", "large"])
    unit = F.when(F.col("column") == "tiny", TINY).when(F.col("column") == "large", SHIFT).otherwise(1.0)
    return s.select("column", "n", *[F.round(F.col(c) / unit, 10).alias(c) for c in ("mean", "std_samp", "std_pop")])


def standardize_exact(spark, sf):
    df = features.standardize(points_view(spark, sf).select(*POINT_KEY, *FEATURES), FEATURES, ddof=0, exact=True)
    return df.select(*POINT_KEY, *[_r(c) for c in FEATURES])


# ---- standardization --------------------------------------------------------

def standardize_sample(spark, sf):
    """MLlib assembler + scaler, mean and sample std."""
    df = features.mllib_standardize(points_view(spark, sf).select(*POINT_KEY, *FEATURES), FEATURES)
    return df.select(*POINT_KEY, *[_r(c) for c in FEATURES])


def standardize_population(spark, sf):
    """Column expressions, mean and population std."""
    df = features.standardize(points_view(spark, sf).select(*POINT_KEY, *FEATURES), FEATURES, ddof=0)
    return df.select(*POINT_KEY, *[_r(c) for c in FEATURES])


def standardize_std_only(spark, sf):
    """MLlib scaler without centering, on the forest's four features."""
    df = features.derive_and_filter(points_view(spark, sf), FILTER_MIN_NEW_FEATURE, FILTER_MAX_F2_F3)
    df = df.select(*POINT_KEY, *FOREST_FEATURES)
    out = features.mllib_standardize(df, FOREST_FEATURES, with_mean=False)
    return out.select(*POINT_KEY, *[_r(c) for c in FOREST_FEATURES])


# ---- clustering -------------------------------------------------------------

def assign_nearest_fixed(spark, sf):
    df = points_view(spark, sf)
    return clustering.assign_nearest(df, FEATURES, FIXED_CENTERS).select(*POINT_KEY, "cluster")


def assign_nearest_array(spark, sf):
    """Wide vectors in one array column."""
    df = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return clustering.assign_nearest(df, "v", ARRAY_CENTERS).select("vec_id", "cluster")


def update_centers_empty(spark, sf):
    df = clustering.assign_nearest(points_view(spark, sf), FEATURES, EMPTY_CLUSTER_CENTERS)
    out = clustering.update_centers_frame(df, FEATURES, len(EMPTY_CLUSTER_CENTERS))
    return out.select("cluster", *[_r(c) for c in FEATURES], "n")


def _lloyd(spark, sf):
    # Statistics at 12 significant digits: exact distance ties between the first-k
    # centers (the features are on a discrete grid) then break the same way everywhere.
    return clustering.lloyd_standardized(points_view(spark, sf), FEATURES, POINT_KEY, k=LLOYD_K,
                                         max_iters=LLOYD_ITERS, ddof=0, digits=LLOYD_DIGITS)


def lloyd_centers(spark, sf):
    res, _, _ = _lloyd(spark, sf)
    c = clustering.centers_frame(spark, res.centers, FEATURES)
    return c.select("cluster", *[_r(x) for x in FEATURES])


def lloyd_cluster_sizes(spark, sf):
    _, sizes, _ = _lloyd(spark, sf)
    return spark.createDataFrame(sizes, "cluster INT, n BIGINT").orderBy("cluster")


def kmeans_cluster_sizes(spark, sf):
    pts = points_view(spark, sf).select(*FEATURES)
    model = clustering.fit_kmeans(pts, FEATURES, k=2, max_iter=3, seed=42)
    return clustering.kmeans_cluster_sizes(model, pts)


def kmeans_centers(spark, sf):
    pts = points_view(spark, sf).select(*FEATURES)
    model = clustering.fit_kmeans(pts, FEATURES, k=2, max_iter=3, seed=42)
    c = clustering.centers_frame(spark, clustering.kmeans_centers(model, FEATURES), FEATURES)
    return c.select("cluster", *[_r(x) for x in FEATURES])


def kmeans_checks(spark, sf):
    """What no seed decides: every row is assigned, and to the nearest of the fitted centers."""
    pts = points_view(spark, sf).select(*FEATURES)
    model = clustering.fit_kmeans(pts, FEATURES, k=2, max_iter=3, seed=42)
    out = model.transform(pts).withColumn("v", vector_to_array("features"))
    out = clustering.assign_nearest(out, "v", clustering.kmeans_centers(model, FEATURES), "nearest")
    return out.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("nearest") != F.col("prediction")).cast("bigint")).alias("not_nearest"))


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))


def assign_nearest_many(spark, sf):
    """Two hundred centers: the first vectors of the table."""
    df = _embeddings(spark, sf)
    return vectors.assigned(df, "v", vectors.first_vectors(df, "v", MANY_CENTERS, ["vec_id"])).select("vec_id", "cluster")


def vector_stats(spark, sf):
    """Mean and population deviation of every dimension of an array column."""
    mean, std = vectors.vector_statistics(_embeddings(spark, sf), "v", 0)
    df = spark.createDataFrame([(i, m, s) for i, (m, s) in enumerate(zip(mean, std))], "dimension INT, mean DOUBLE, std_pop DOUBLE")
    return df.select("dimension", F.round("mean", 9).alias("mean"), F.round("std_pop", 9).alias("std_pop"))


def lloyd_vectors(spark, sf):
    """Lloyd's iteration on an array column, with assignments pruned by the triangle inequality."""
    res = vectors.lloyd(_embeddings(spark, sf), "v", k=VECTOR_K, max_iters=LLOYD_ITERS, tol=0.0, key=["vec_id"], prune=True)
    return vectors.centers_rows(spark, res.centers).select("cluster", "dimension", _r("value"))


def lloyd_converged(spark, sf):
    """From far apart centers, on one feature, until the centers stay: how many steps that takes, and where they are."""
    res = clustering.lloyd_kmeans(points_view(spark, sf).select(FEATURES[0]), [FEATURES[0]], k=2, max_iters=CONVERGE_ITERS, tol=1e-9, init=CONVERGE_INIT)
    rows = [(i, c[0], res.iterations, res.converged) for i, c in enumerate(res.centers)]
    return spark.createDataFrame(rows, "cluster INT, center DOUBLE, iterations INT, converged BOOLEAN").select("cluster", _r("center"), "iterations", "converged")


def _seeded(spark, sf):
    path = shared_dir(spark, "seeded-points")  # the statistics, the seeding, the steps and the sizes read the points
    points_view(spark, sf).select(*POINT_KEY, *FEATURES).write.parquet(path)
    pts = features.standardize(spark.read.parquet(path), FEATURES, ddof=1, exact=True)
    init = seeding.parallel_centers(pts.withColumn("v", F.array(*FEATURES)), "v", POINT_KEY, LLOYD_K, BAG_SEED)
    return pts, clustering.lloyd_kmeans(pts, FEATURES, k=LLOYD_K, max_iters=LLOYD_ITERS, tol=0.0, init=init, handle_invalid="skip")


def kmeans_seeded_centers(spark, sf):
    """k-means|| by hashes and three steps: the same centers however the rows lie."""
    _, res = _seeded(spark, sf)
    return clustering.centers_frame(spark, res.centers, FEATURES).select("cluster", *[_r(c) for c in FEATURES])


def kmeans_seeded_sizes(spark, sf):
    pts, res = _seeded(spark, sf)
    return clustering.cluster_sizes(pts, FEATURES, res.centers)


# ---- splits -----------------------------------------------------------------

def split_hash(spark, sf):
    df = split.with_hash_side(points_view(spark, sf), POINT_KEY, 0.7)
    return df.select(*POINT_KEY, "bucket", "is_train")


def split_tail(spark, sf):
    df = split.with_tail_side(points_view(spark, sf).select(*POINT_KEY), POINT_KEY, 0.3)
    return df.select(*POINT_KEY, "is_train")


def split_tail_ties(spark, sf):
    """A key with some fifty values: how many rows of each value there are and are train."""
    df = split.with_tail_side(points_view(spark, sf).select(*POINT_KEY, FEATURES[0]), [FEATURES[0]], 0.3)
    return df.groupBy(FEATURES[0]).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_train").cast("bigint")).alias("n_train"))


def split_tail_nulls(spark, sf):
    """A key whose first column is null in a good part of the rows."""
    df = points_view(spark, sf).select(*POINT_KEY, F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("k"))
    df = split.with_tail_side(df, ["k", "l_orderkey", "l_partkey", "l_suppkey"], 0.3)
    return df.select(*POINT_KEY, "is_train")


def split_random_cover(spark, sf):
    """Both sides of the random split together are the input, once each."""
    train, valid = split.random_split(points_view(spark, sf).select(*POINT_KEY), 0.7, seed=42)
    return train.unionByName(valid)


def repartitioned(spark, sf):
    """Round-robin and by key: the rows stay what they are."""
    df = points_view(spark, sf).select(*POINT_KEY, *FEATURES, "label")
    return df.repartition(7).repartition(5, "l_orderkey")


def split_seeded(spark, sf):
    train, valid = split.random_split(points_view(spark, sf).select(*POINT_KEY), 0.7, BAG_SEED, POINT_KEY)
    return train.withColumn("is_train", F.lit(True)).unionByName(valid.withColumn("is_train", F.lit(False)))


def split_random(spark, sf):
    df = points_view(spark, sf).select(*POINT_KEY)
    train, valid = split.random_split(df, 0.7, seed=42)
    return train.withColumn("is_train", F.lit(True)).unionByName(valid.withColumn("is_train", F.lit(False)))


# ---- forest -----------------------------------------------------------------

def _forest_data(spark, sf):
    df = features.derive_and_filter(points_view(spark, sf), FILTER_MIN_NEW_FEATURE, FILTER_MAX_F2_F3)
    df = df.select(*POINT_KEY, *FOREST_FEATURES, "label")
    return split.hash_split(df, POINT_KEY, 0.7)


def forest_scores(spark, sf):
    train, valid = _forest_data(spark, sf)
    model = classify.fit_forest(train, FOREST_FEATURES, num_trees=4, max_depth=3, seed=42)
    return classify.score(model, valid, keep=POINT_KEY)


def forest_sampled_scores(spark, sf):
    train, valid = _forest_data(spark, sf)
    model = classify.fit_forest(train, FOREST_FEATURES, num_trees=4, max_depth=3, seed=42,
                                subsampling_rate=0.8, feature_subset="0.8")
    return classify.score(model, valid, keep=POINT_KEY)


def model_roundtrip(spark, sf):
    """A saved and loaded model scores every held-out row as before."""
    train, valid = _forest_data(spark, sf)
    model = classify.fit_forest(train, FOREST_FEATURES, num_trees=4, max_depth=3, seed=42)
    path = shared_dir(spark, "forest-model")
    classify.save_model(model, path)
    a, b = (classify.score(m, valid, keep=POINT_KEY) for m in (model, classify.load_model(path)))
    j = a.join(b.select(*POINT_KEY, F.col("prediction").alias("prediction2"), F.col("p1").alias("p2")), POINT_KEY)
    wrong = (F.col("prediction") != F.col("prediction2")) | (F.col("p1") != F.col("p2"))
    return j.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(wrong.cast("bigint")), F.lit(0)).alias("mismatches"))


def forest_bag_weights(spark, sf):
    """Draws of four trees: Poisson counts, and rows kept with probability 0.8."""
    df = points_view(spark, sf).select(*POINT_KEY)
    df = bagging.bag_weights(df, POINT_KEY, 4, 1.0, True, BAG_SEED)
    return bagging.bag_weights(df, POINT_KEY, 4, BAG_RATE, False, BAG_SEED, prefix="b")


def _bagged(spark, sf, **forest):
    train, valid = _forest_data(spark, sf)
    return bagging.fit_bagged_forest(train, FOREST_FEATURES, POINT_KEY, seed=BAG_SEED, **forest), valid


def stump_scores(spark, sf):
    """One tree of depth 1 on all rows and features: classes and probabilities of the held-out rows."""
    model, valid = _bagged(spark, sf, num_trees=1, max_depth=1, rate=1.0, replacement=False)
    return bagging.bagged_scores(model, valid, POINT_KEY).select(*POINT_KEY, "prediction", F.round("p1", 9).alias("p1"))


def bagged_stump_scores(spark, sf):
    """Four trees of depth 1, each on 0.8 of the rows and 0.5 of the features."""
    model, valid = _bagged(spark, sf, num_trees=4, max_depth=1, rate=BAG_RATE, replacement=False, feature_fraction=0.5)
    return bagging.bagged_scores(model, valid, POINT_KEY).select(*POINT_KEY, "prediction", F.round("p1", 9).alias("p1"))


def forest_staged_metrics(spark, sf):
    """Metrics of the held-out rows after 1 to 4 trees of depth 1 on Poisson draws."""
    model, valid = _bagged(spark, sf, num_trees=4, max_depth=1, rate=1.0, replacement=True, feature_fraction=0.5)
    m = bagging.staged_metrics(bagging.staged_scores(model, valid, ["label"]))
    return m.select("trees", "n", _r("accuracy"), _r("log_loss"))


def rule_metrics(spark, sf):
    """The metrics of a fixed rule's scores (many tied scores)."""
    p1 = F.col(FEATURES[0]) / 51.0
    df = points_view(spark, sf).select("label", p1.alias("p1"), (p1 > 0.5).cast("int").alias("prediction"))
    return classify.metrics(df).select("n", _r("accuracy"), _r("log_loss"), _r("auc"))


def phase_report(spark, sf):
    """Phases, status and results of the Lloyd and the triangle job."""
    lloyd = jobs.lloyd_job(points_view(spark, sf), POINT_KEY, k=LLOYD_K, max_iters=LLOYD_ITERS)
    tri = jobs.triangle_job(part_graph(spark, sf), "a", "b")
    df = lloyd.report.to_df(spark).unionByName(tri.report.to_df(spark))
    return df.where("phase <> 'cluster_sizes'").select("job", "phase", "status", "value")


def _read_reports(spark, place):
    """Lines of all reports in a directory of reports, without their timings."""
    line = F.col("value")
    part = lambda i: F.regexp_extract(line, r"^(\S+) +(\S+?):(?: [0-9.]+ s)? *(?:value=)?(.*)$", i)
    return spark.read.text(f"{place}*").select(part(1).alias("job"), part(2).alias("phase"), part(3).alias("result"))


def success_reports(spark, sf):
    """The text reports that two runs of the triangle job leave in one directory, read back."""
    place = shared_dir(spark, "reports") + "/"
    with scratch(spark):
        # Both runs load the same input, which is made once; each does all of its job.
        edges = write_parquet(part_graph(spark, sf), shared_dir(spark, "part-graph"))
        for _ in range(2):
            jobs.triangle_job(edges, "a", "b", report_path=place)
    return _read_reports(spark, place)


def error_reports(spark, sf):
    """The report of a job that fails (a feature is null where the line is the first of its order), read back."""
    place = shared_dir(spark, "errors") + "/"
    broken = points_view(spark, sf).withColumn(FEATURES[0], F.when(F.col("l_linenumber") > 1, F.col(FEATURES[0])))
    try:
        jobs.lloyd_job(broken, POINT_KEY, error_path=place)
    except ValueError:
        return _read_reports(spark, place)
    raise AssertionError("the job did not fail")


def forest_metrics(spark, sf):
    return classify.metrics(forest_scores(spark, sf))


# ---- graph ------------------------------------------------------------------

def edges_cast(spark, sf):
    return edge_io.cast_edges(raw_string_edges(spark, sf), on_bad="drop")


def graph_vertices(spark, sf):
    return graph.vertices(messy_part_edges(spark, sf))


def graph_canonical_edges(spark, sf):
    return graph.canonical_edges(messy_part_edges(spark, sf))


def triangle_counts(spark, sf):
    return graph.triangle_counts(part_graph(spark, sf), "a", "b", canonical=True)


def triangle_counts_raw(spark, sf):
    """Same answer from the raw directed list (both directions, duplicates,
    self-loops): exercises canonicalization inside the count."""
    return graph.triangle_counts(messy_part_edges(spark, sf))


def triangle_counts_subset(spark, sf):
    nodes = table(spark, sf, "part").filter(F.col("p_size") <= SUBSET_MAX_SIZE) \
        .select(F.col("p_partkey").alias("id"))
    return graph.triangle_counts(part_graph(spark, sf), "a", "b", nodes=nodes, canonical=True)


def triangle_total(spark, sf):
    return graph.triangle_total(part_graph(spark, sf), "a", "b", canonical=True)


def triangle_total_id_order(spark, sf):
    return graph.triangle_total(part_graph(spark, sf), "a", "b", order="id", canonical=True)


def triangle_total_colours(spark, sf):
    return graph.triangle_total(part_graph(spark, sf), "a", "b", canonical=True, method="colours")


def triangle_counts_colours(spark, sf):
    """From the raw directed list, by colour triples of small tasks, some vertices heavy."""
    return graph.triangle_counts(messy_part_edges(spark, sf), method="colours", task_edges=SMALL_TASK)


def triangle_counts_subset_colours(spark, sf):
    nodes = table(spark, sf, "part").filter(F.col("p_size") <= SUBSET_MAX_SIZE).select(F.col("p_partkey").alias("id"))
    return graph.triangle_counts(part_graph(spark, sf), "a", "b", nodes=nodes, canonical=True, method="colours")


def _by_vertex(spark, sf):
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.table(graph.store_by_vertex(part_graph(spark, sf), "a", "b", buckets, canonical=True))


def degrees_stored(spark, sf):
    return graph.degrees_by_vertex(_by_vertex(spark, sf)).select(F.col("u").alias("id"), "deg")


def triangle_counts_stored(spark, sf):
    return graph.triangle_counts_by_vertex(_by_vertex(spark, sf))


def triangle_total_stored(spark, sf):
    return graph.triangle_total_by_vertex(_by_vertex(spark, sf), order="id")


def triangle_total_from_counts(spark, sf):
    return graph.total_from_counts(triangle_counts_raw(spark, sf))


# ---- sources / sinks round trips --------------------------------------------

def csv_roundtrip(spark, sf):
    path = shared_dir(spark, "points-csv")
    point_io.write_points(points_view(spark, sf).select(*[f.name for f in point_io.POINTS_SCHEMA]), path)
    return point_io.read_points(spark, path)


def csv_inferred_roundtrip(spark, sf):
    path = shared_dir(spark, "points-csv-inferred")
    point_io.write_points(points_view(spark, sf).select(*[f.name for f in point_io.POINTS_SCHEMA]), path)
    return point_io.read_points(spark, path, schema=None)


def edgelist_roundtrip(spark, sf):
    path = shared_dir(spark, "edge-list")
    edge_io.write_edge_list(part_graph(spark, sf), path, "a", "b", sep=" ")
    return edge_io.read_edge_list(spark, path)


def edges_tsv_roundtrip(spark, sf):
    path = shared_dir(spark, "edges-tsv")
    edge_io.write_edge_list(part_graph(spark, sf), path, "a", "b", sep="\t", header="u\tv")
    return edge_io.read_edges(spark, path, sep="\t")


def edge_list_short_lines(spark, sf):
    """Lines with one id among lines with two."""
    one = F.col("l_linenumber") == 1
    lines = table(spark, sf, "lineitem").select(F.when(one, F.col("l_partkey").cast("string")).otherwise(F.concat_ws(" ", "l_partkey", "l_suppkey")).alias("value"))
    path = shared_dir(spark, "short-lines")
    lines.write.text(path)
    return edge_io.read_edge_list(spark, path, header=False, on_bad="drop")


def synth_points(spark, sf):
    """One generated point for each lineitem row, from the row's key."""
    ids = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("id"))
    df = points_for_ids(ids, seed=42, partitions=2 * spark.sparkContext.defaultParallelism)
    return df.select("id", *[_r(c) for c in FEATURES], "category_1", "category_2", "label")


QUERIES: dict[str, Query] = {f.__name__: f for f in [
    points_project, points_derive_filter, points_derive_filter_original, label_counts, column_stats, column_stats_magnitudes, column_stats_exact, repartitioned,
    standardize_sample, standardize_population, standardize_std_only, standardize_exact,
    assign_nearest_fixed, assign_nearest_array, update_centers_empty, lloyd_centers, lloyd_cluster_sizes,
    kmeans_cluster_sizes, kmeans_centers, kmeans_checks, kmeans_seeded_centers, kmeans_seeded_sizes,
    assign_nearest_many, vector_stats, lloyd_vectors, lloyd_converged,
    split_hash, split_tail, split_tail_ties, split_tail_nulls, split_random, split_random_cover, split_seeded,
    forest_scores, forest_sampled_scores, forest_metrics, model_roundtrip, rule_metrics, phase_report,
    success_reports, error_reports,
    forest_bag_weights, stump_scores, bagged_stump_scores, forest_staged_metrics,
    edges_cast, graph_vertices, graph_canonical_edges,
    triangle_counts, triangle_counts_raw, triangle_counts_subset,
    triangle_total, triangle_total_id_order, triangle_total_from_counts,
    triangle_total_colours, triangle_counts_colours, triangle_counts_subset_colours,
    degrees_stored, triangle_counts_stored, triangle_total_stored,
    csv_roundtrip, csv_inferred_roundtrip, edgelist_roundtrip, edges_tsv_roundtrip, edge_list_short_lines,
    synth_points,
]}
