"""Undirected graph operators over an edge DataFrame: vertices, canonical
edges, per-vertex triangle counts and the total of unique triangles.

Algorithm (adjacency intersection over an oriented graph):

1. canonical edges ``(a, b)``, ``a < b``: self-loops dropped, direction and
   duplicates merged;
2. orient every edge from the lower to the higher *rank*.  With
   ``order="degree"`` the rank is ``(degree, id)``; every vertex then has at
   most ``sqrt(2m)`` out-neighbours however large its degree, so no
   adjacency list grows with a hub.  ``order="id"`` ranks by id, with the
   hot vertices (below) moved above all others: lists stay bounded by the
   hot threshold, and the edges are never joined with the degree table;
3. ``adj(u)`` = out-neighbours of ``u`` in rank order (``collect_list`` per
   vertex, bounded by step 2);
4. for every oriented edge ``u -> v``: ``adj(u) ∩ adj(v)`` are the third
   corners ``w`` of the triangles whose two lowest-ranked corners are ``u``
   and ``v``, so every triangle is found exactly once.  Such a ``w`` ranks
   above ``v``, so only the part of ``adj(u)`` after ``v`` is intersected.

Counts and totals of graphs whose ids are whole numbers ship each list once, packed, to every group
of vertices that it meets (:mod:`lodestar.operators.lists`).  Where the corners themselves are
wanted (:func:`closing_corners`), and for other ids, the oriented edges come from exploding ``adj`` itself, which carries
``adj(u)`` along without a join; a single shuffle (by ``v``) brings
``adj(v)`` next to it.  Nothing is collected on the driver; the total is one
aggregate.

Hot vertices.  A hub can hold a large share of all edges, and a join keyed
by it would put that share in one task (adaptive skew handling does not
apply when one join side is an aggregate).  So the rows of a vertex whose
degree is above a threshold ``T`` are dealt over ``degree / T`` tasks
(:mod:`lodestar.functions.hotkeys`), and its degree or adjacency row is
repeated for each.  Only the ids and split counts of these vertices are
broadcast, at most ``max_hot`` rows; ``T`` is ``hot_degree`` unless more
vertices than that are above it, and never reaches ``4m / max_hot``.

Where vertices are hot, an adjacency list is also cut into blocks of
``BLOCK`` ids that are shuffled before the edges are made from it: a list of
``d`` ids gives ``d (d - 1) / 2`` suffix ids, of which a task then makes at most
``BLOCK * d`` for one block.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions import hotkeys
from lodestar.operators import colours, lists
from lodestar.session import freed_shuffles, shared_dir, write_parquet


def vertices(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct non-null endpoints of an edge table, as ``id``.  One scan
    (both endpoints through one ``explode``) and one aggregate."""
    ids = edges.select(F.explode(F.array(F.col(src), F.col(dst))).alias("id"))
    return ids.filter(F.col("id").isNotNull()).distinct()


def canonical_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Undirected simple graph ``(a, b)`` with ``a < b``: reciprocal and
    duplicate edges merged, self-loops and null ends dropped."""
    e = edges.filter(F.col(src) != F.col(dst))
    canon = e.select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b")).distinct()
    # Stated after the distinct so that every consumer of ``canon`` (degrees
    # and the orientation join) gets the same pushed-down filter: the two
    # subtrees then plan identically and the shuffle is computed once and
    # reused, instead of once per consumer.
    return canon.filter(F.col("a").isNotNull() & F.col("b").isNotNull())


def degrees(canon: DataFrame) -> DataFrame:
    """``(id, deg)`` of a canonical edge table (vertices with an edge only)."""
    ends = canon.select(F.explode(F.array("a", "b")).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("deg"))


HOT_DEGREE = 10_000           # the rows of a vertex above this degree are dealt over several tasks
MAX_HOT = hotkeys.MAX_HOT     # at most so many vertices, or else the threshold rises
BLOCK = 1_024                 # ids of a long adjacency list whose edges one task makes


def hot_vertices(deg: DataFrame, hot_degree: int = HOT_DEGREE,
                 max_hot: int = MAX_HOT) -> tuple[DataFrame, int, int]:
    """``(hot, T, n_hot)``: the ``n_hot <= max_hot`` vertices with degree above
    ``T`` (``id, deg``), see :func:`hotkeys.threshold`."""
    t, n = hotkeys.threshold(deg, "deg", hot_degree, max_hot)
    return deg.filter(F.col("deg") > t).select("id", "deg"), t, n


def _stored(df: DataFrame, name: str, store: bool = True) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: later passes read the
    table instead of recomputing it, the lineage is cut there, and the files of its shuffles are deleted.  With ``store``
    false, ``df`` itself.  Callers delete the tables (``session.scratch``)."""
    return write_parquet(df, shared_dir(df.sparkSession, name)) if store else df


def _freed(operator: Callable) -> Callable:
    """``operator`` (of a DataFrame) with the shuffle files of the queries that it runs deleted after each; what it returns is not run by it."""
    @functools.wraps(operator)
    def run(edges: DataFrame, *args, **kwargs):
        with freed_shuffles(edges.sparkSession):
            return operator(edges, *args, **kwargs)
    return run


def _orient(canon: DataFrame, order: str, hot_degree: int, max_hot: int, deg: DataFrame | None = None):
    """``(oriented edges, hot, T)``; the edges are ``(u, v)`` plus
    the rank of ``v`` beyond its id: ``rd`` (degree) and, in id order with
    hot vertices, ``rh`` (1 for a hot vertex).  ``hot`` is None without hot vertices.
    ``deg``: the stored :func:`degrees`, if there are.

    ``degree``: rank = (degree, id).  ``id``: rank = id, except that hot
    vertices rank above all others, by (degree, id): a cold vertex then has
    at most its degree (<= T) out-neighbours and a hot one only hot
    out-neighbours of at least its degree (<= sqrt(2m)), and only broadcast joins with the hot set
    are needed (no join of the edges with the whole degree table)."""
    if order not in ("degree", "id"):
        raise ValueError("order must be 'degree' or 'id'")
    if deg is None:
        # In degree order read by the counts below and by both orientation joins.
        deg = _stored(degrees(canon), "degrees", order == "degree")
    hot, t, n_hot = hot_vertices(deg, hot_degree, max_hot)
    if n_hot:
        # The hot set and the edges are read several times below.
        hot = _stored(hot, "hot-vertices")
        canon = _stored(canon, "canonical-edges")
    else:
        hot = None
    a, b = F.col("a"), F.col("b")
    if order == "id":
        if hot is None:  # plain id order; adjacency sorts the ids themselves
            return canon.select(a.alias("u"), b.alias("v")), None, t
        few = F.broadcast(hot)  # <= max_hot rows
        e = (canon.join(few.select(F.col("id").alias("a"), F.col("deg").alias("da")), "a", "left")
                  .join(few.select(F.col("id").alias("b"), F.col("deg").alias("db")), "b", "left"))
        ha, hb = F.col("da").isNotNull().cast("int"), F.col("db").isNotNull().cast("int")
        da, db = F.coalesce("da", F.lit(0).cast("bigint")), F.coalesce("db", F.lit(0).cast("bigint"))
        a_first = (ha < hb) | ((ha == hb) & ((da < db) | ((da == db) & (a < b))))
        return e.select(F.when(a_first, a).otherwise(b).alias("u"), F.when(a_first, b).otherwise(a).alias("v"),
                        F.when(a_first, hb).otherwise(ha).alias("rh"),
                        F.when(a_first, db).otherwise(da).alias("rd")), hot, t
    e = canon
    for end, other, name in (("a", "b", "da"), ("b", "a", "db")):
        split = None if hot is None else hotkeys.salts(hot, "id", "deg", t, end)
        e = hotkeys.salted_join(e, deg.select(F.col("id").alias(end), F.col("deg").alias(name)), end, other, split)
    a_first = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (a < b))
    return e.select(F.when(a_first, a).otherwise(b).alias("u"), F.when(a_first, b).otherwise(a).alias("v"),
                    F.when(a_first, F.col("db")).otherwise(F.col("da")).alias("rd")), hot, t


def oriented_edges(canon: DataFrame, order: str = "degree", hot_degree: int = HOT_DEGREE,
                   max_hot: int = MAX_HOT) -> DataFrame:
    """Each canonical edge as ``(u, v)`` with ``rank(u) < rank(v)``."""
    return _orient(canon, order, hot_degree, max_hot)[0].select("u", "v")


def adjacency(oriented: DataFrame, beside: Sequence[str] = ()) -> DataFrame:
    """``(u, nbrs)``: out-neighbours of every vertex with an out-edge, in
    increasing rank (``rh``, ``rd`` when given, then ``v``); with ``beside`` they are structs of ``v`` and those columns.

    The not-null filter is explicit so that both consumers of ``adj`` in
    :func:`closing_corners` see the same plan and share one computation."""
    o = oriented.filter(F.col("u").isNotNull())
    rank = [c for c in ("rh", "rd") if c in oriented.columns]
    if not rank and not beside:
        return o.groupBy("u").agg(F.array_sort(F.collect_list("v")).alias("nbrs"))
    key = F.struct(*rank, "v", *beside)  # flat: arrays of flat structs sort fast
    kept = (lambda x: F.struct(x["v"].alias("v"), *[x[c].alias(c) for c in beside])) if beside else (lambda x: x["v"])
    return o.groupBy("u").agg(F.array_sort(F.collect_list(key)).alias("nb")).select("u", F.transform("nb", kept).alias("nbrs"))


def closing_corners(edges: DataFrame, src: str = "src", dst: str = "dst",
                    order: str = "degree", canonical: bool = False,
                    hot_degree: int = HOT_DEGREE, max_hot: int = MAX_HOT, store_input: bool = True) -> DataFrame:
    """``(u, v, c)`` for every oriented edge, ``c`` = third corners of the
    triangles it closes (possibly empty).

    ``canonical=True`` skips step 1 when the input is already ``(a, b)``
    with ``a < b``, distinct.  ``store_input``: the edges are read several
    times; set it false if they are a stored table already.
    """
    return _corners(_stored(edges, "edges", store_input), src, dst, order, canonical, hot_degree, max_hot, every=True)


def _corners(edges: DataFrame, src: str, dst: str, order: str, canonical: bool,
             hot_degree: int, max_hot: int, every: bool = False, wanted: DataFrame | None = None, deg: DataFrame | None = None) -> DataFrame:
    """See :func:`closing_corners`; without ``every``, edges that no third corner can follow are left out.

    ``wanted`` (``id``): only triangles with a wanted corner.  Where neither end of an edge is wanted
    it carries only the wanted ids of its suffix, so what is shuffled follows the subset."""
    canon = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")) if canonical \
        else canonical_edges(edges, src, dst)
    oriented, hot, t = _orient(canon, order, hot_degree, max_hot, deg)
    if wanted is None:
        adj = ids = adjacency(oriented)
    else:
        adj = _stored(adjacency(_marked(oriented, wanted, "v", "wv", max_hot), ["wv"]), "adjacency")
        ids = adj.select("u", F.transform("nbrs", lambda x: x["v"]).alias("nbrs"))
        adj = _marked(adj, wanted, "u", "wu", max_hot)
    own = [] if wanted is None else ["wu"]
    # A triangle u < v < w (by rank) is found at its lowest edge u -> v, and
    # w ranks above v: only the part of adj(u) after v can hold it.  With
    # adj(u) in rank order each edge carries that suffix, not the whole list.
    block = min(BLOCK, max(t, 1))
    tails, split = adj, None
    if hot is not None:
        tails = adj.select("u", *own, F.explode(F.sequence(F.lit(1), F.size("nbrs"), F.lit(block))).alias("at"), "nbrs") \
            .select("u", *own, "at", F.slice("nbrs", F.col("at"), F.size("nbrs") - F.col("at") + 1).alias("nbrs")) \
            .repartition("u", "at")
        split = hotkeys.salts(hot, "id", "deg", t, "v")
    starts = F.col("nbrs") if hot is None else F.slice("nbrs", 1, block)
    suffix = F.slice("nbrs", F.col("i") + 2, F.size("nbrs") - F.col("i") - 1)
    fwd = tails.select("u", *own, F.posexplode(starts).alias("i", "v"), "nbrs")
    if wanted is None:
        fwd = fwd.select("u", "v", suffix.alias("nu"))
    else:
        some = F.when(F.col("wu") | F.col("v.wv"), suffix).otherwise(F.filter(suffix, lambda x: x["wv"]))
        fwd = fwd.select("u", F.col("v.v").alias("v"), F.transform(some, lambda x: x["v"]).alias("nu"))
    if not every:
        fwd = fwd.where(F.size("nu") > 0)
    back = ids.select(F.col("u").alias("v"), F.col("nbrs").alias("nv"))
    j = hotkeys.salted_join(fwd, back, "v", "u", split)
    return j.select("u", "v", F.array_intersect("nu", "nv").alias("c"))


def _marked(rows: DataFrame, wanted: DataFrame, key: str, name: str, max_hot: int) -> DataFrame:
    """``rows`` with a column ``name``: whether ``key`` is one of the stored ``wanted``."""
    mark = wanted.select(F.col("id").alias(key), F.lit(True).alias(name))
    return rows.join(_small(wanted, mark, max_hot), key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def _closed(canon: DataFrame, order: str, hot_degree: int, max_hot: int, counts: bool, wanted: DataFrame | None = None,
            deg: DataFrame | None = None) -> DataFrame:
    """Rows ``(id, cnt)``, or ``cnt`` without ``counts``, to be summed: the triangles of the stored edges ``canon`` (``a, b``); with ``wanted``
    at least those with a wanted corner.  Lists of whole numbers are packed and meet by groups (:mod:`lodestar.operators.lists`);
    for other ids they go with the edges (:func:`closing_corners`)."""
    if not lists.fits(canon.schema["a"].dataType) or not lists.fits(canon.schema["b"].dataType):
        t = _corners(canon, "a", "b", order, True, hot_degree, max_hot, wanted=wanted, deg=deg)
        return _contributions(t) if counts else t.select(F.size("c").cast("bigint").alias("cnt"))
    oriented = _orient(canon, order, hot_degree, max_hot, deg)[0]
    if wanted is None:
        adj = adjacency(oriented)
    else:
        adj = adjacency(_marked(oriented, wanted, "v", "wv", max_hot), ["wv"])
        adj = _marked(adj, wanted, "u", "wu", max_hot).select("u", "wu", F.col("nbrs.v").alias("nbrs"), F.col("nbrs.wv").alias("marks"))
    # The shuffles of the orientation are off the disks before the lists are shuffled.
    return _by_lists(adj, canon.count(), counts, store=True)


def _by_lists(adj: DataFrame, m: int, counts: bool, store: bool = False) -> DataFrame:
    cores = adj.sparkSession.sparkContext.defaultParallelism
    groups = lists.group_count(m, cores)
    rounds = lists.round_count(groups, cores)
    adj = _stored(adj, "adjacency", store or rounds > 1)  # every round reads them
    return lists.in_rounds([lists.triangles(adj, groups, counts, part=r, parts=rounds) for r in range(rounds)], _stored)


def _contributions(corners: DataFrame) -> DataFrame:
    """``(id, cnt)`` of ``(u, v, c)``: u and v are in |c| triangles each; every w in c is in one more."""
    n = F.size("c").cast("bigint")
    return corners.where(F.size("c") > 0).select(F.inline(F.concat(
        F.array(F.struct(F.col("u").alias("id"), n.alias("cnt")),
                F.struct(F.col("v").alias("id"), n.alias("cnt"))),
        F.transform("c", lambda w: F.struct(w.alias("id"), F.lit(1).cast("bigint").alias("cnt"))))))


def _small(table: DataFrame, same: DataFrame, max_hot: int) -> DataFrame:
    """``same`` (a form of ``table``) marked for broadcast if the stored ``table`` has at most ``max_hot`` rows."""
    return F.broadcast(same) if table.limit(max_hot + 1).count() <= max_hot else same


def neighbourhood(canon: DataFrame, nodes: DataFrame, max_hot: int = MAX_HOT) -> DataFrame:
    """The edges of ``canon`` that triangles through ``nodes`` (``id``) can have: both ends are wanted or next to a wanted vertex.

    The wanted vertices and then the vertices next to them are written to the shared folder
    and counted; up to ``max_hot`` ids are broadcast, so the edges are only filtered where they
    lie, and more are joined by shuffles of plain tables (whose hot keys adaptive execution splits).
    """
    def within(ids: DataFrame, name: str) -> DataFrame:
        ids = _stored(ids, name)
        return _small(ids, ids, max_hot)

    wanted = within(nodes.select("id").where("id is not null").distinct(), "wanted")
    next_to = [canon.join(wanted, F.col(end) == F.col("id"), "left_semi").select(F.explode(F.array("a", "b")).alias("id")) for end in ("a", "b")]
    near = within(next_to[0].unionByName(next_to[1]).distinct(), "neighbourhood")
    return canon.join(near, F.col("a") == F.col("id"), "left_semi").join(near, F.col("b") == F.col("id"), "left_semi")


def _by_colours(edges: DataFrame, src: str, dst: str, canonical: bool, store_input: bool, task_edges: int, deg: DataFrame | None = None) -> colours.Parts:
    canon = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")) if canonical else canonical_edges(edges, src, dst)
    canon = _stored(canon, "canonical-edges", store_input or not canonical)
    return colours.Parts(canon, degrees(canon) if deg is None else deg, _stored, task_edges)


@_freed
def triangle_counts(edges: DataFrame, src: str = "src", dst: str = "dst",
                    nodes: DataFrame | None = None, order: str = "degree",
                    canonical: bool = False, hot_degree: int = HOT_DEGREE,
                    max_hot: int = MAX_HOT, store_input: bool = True,
                    method: str = "adjacency", task_edges: int = colours.TASK_EDGES) -> DataFrame:
    """``(id, count)``: number of triangles through each vertex, for every
    vertex of ``edges`` (a vertex whose only edge is a self-loop, or that is
    in no triangle, gets 0).  Edge direction is ignored and duplicate edges
    count once.

    ``nodes``: optional DataFrame with an ``id`` column; only those vertices
    (that are in the graph) are returned, only the edges of their
    :func:`neighbourhood` are oriented, and edges carry only ids that may close a
    triangle with a wanted corner.

    ``method``: ``"adjacency"`` (above; ``order``, ``hot_degree`` and ``max_hot`` are its parameters) or
    ``"colours"`` (:mod:`lodestar.operators.colours`, tasks of about ``task_edges`` edges).

    ``store_input``: see :func:`closing_corners`.
    """
    if method not in ("adjacency", "colours"):
        raise ValueError("method must be 'adjacency' or 'colours'")
    # Stored: the degrees, the orientation and the zero rows read them.
    if canonical:
        canon = _stored(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")), "edges", store_input)
    else:
        # The input is read once: what is stored is the simple graph and, as self-loops, the ends of what that leaves out.
        edges = _stored(edges.select(F.least(src, dst).alias(src), F.greatest(src, dst).alias(dst)).distinct(), "simple-edges")
        canon = edges.where(F.col(src) != F.col(dst)).select(F.col(src).alias("a"), F.col(dst).alias("b"))
    deg = all_deg = _stored(degrees(canon), "degrees")
    if nodes is not None:
        canon, deg = _stored(neighbourhood(canon, nodes, max_hot), "neighbourhood-edges"), None
    if method == "colours":
        contrib = _by_colours(canon, "a", "b", True, False, task_edges, deg).counts()
    else:
        wanted = None if nodes is None else _stored(nodes.select("id").where("id is not null").distinct(), "wanted")
        contrib = _closed(canon, order, hot_degree, max_hot, True, wanted, deg)
    # Every endpoint also contributes 0, so vertices without a triangle are kept: those of the simple graph, and the ends of what it leaves out.
    zero = F.lit(0).cast("bigint").alias("cnt")
    zeros = all_deg.select("id", zero)
    if not canonical:
        left_out = edges.where(~F.coalesce(F.col(src) != F.col(dst), F.lit(False)))
        zeros = zeros.unionByName(left_out.select(F.col(src).alias("id"), zero))
    zeros = zeros.where("id is not null")
    rows = contrib.unionByName(zeros)
    if nodes is not None:  # before the aggregate
        rows = rows.join(nodes.select("id").distinct(), "id", "left_semi")
    return rows.groupBy("id").agg(F.sum("cnt").alias("count"))


@_freed
def triangle_total(edges: DataFrame, src: str = "src", dst: str = "dst",
                   order: str = "degree", canonical: bool = False,
                   hot_degree: int = HOT_DEGREE, max_hot: int = MAX_HOT, store_input: bool = True,
                   method: str = "adjacency", task_edges: int = colours.TASK_EDGES) -> DataFrame:
    """One row ``total``: number of unique triangles (integer).  Counts the
    closing corners per oriented edge; no per-vertex sum and no division.
    ``method``: see :func:`triangle_counts`."""
    if method not in ("adjacency", "colours"):
        raise ValueError("method must be 'adjacency' or 'colours'")
    if method == "colours":
        return _by_colours(edges, src, dst, canonical, store_input, task_edges).total()
    canon = _stored(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")), "edges", store_input) if canonical \
        else _stored(canonical_edges(edges, src, dst), "canonical-edges")
    return _total(_closed(canon, order, hot_degree, max_hot, False))


def _total(rows: DataFrame) -> DataFrame:
    return rows.agg(F.coalesce(F.sum("cnt"), F.lit(0).cast("bigint")).alias("total"))


# ---- edge tables stored by vertex -------------------------------------------------------------------------------------

def store_by_vertex(edges: DataFrame, src: str = "src", dst: str = "dst", buckets: int = 64, canonical: bool = False,
                    name: str | None = None) -> str:
    """Write the simple graph once as a table ``(u, v)`` with both directions of every edge, in ``buckets`` buckets by
    ``u`` and sorted by it; returns the table's name (in the session's catalog, its files in the shared folder).

    Whatever groups or joins by ``u`` reads it without a shuffle.  Choose ``buckets`` so that a bucket fits a
    task, and not below the session's shuffle partitions: Spark shuffles smaller tables again.  Delete it with
    ``DROP TABLE`` and ``session.remove_dir``.
    """
    canon = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")) if canonical else canonical_edges(edges, src, dst)
    both = canon.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e"))
    path = shared_dir(edges.sparkSession, "by-vertex")
    name = name or "by_vertex_" + path.rsplit("-", 1)[-1]
    both.select("e.u", "e.v").where("u is not null").repartition(buckets, "u").write.bucketBy(buckets, "u").sortBy("u").option("path", path).format("parquet").saveAsTable(name)
    return name


def degrees_by_vertex(both: DataFrame) -> DataFrame:
    """``(u, deg)`` of a table of :func:`store_by_vertex`; no shuffle."""
    return both.groupBy("u").agg(F.count(F.lit(1)).alias("deg"))


def _ranked_by_vertex(both: DataFrame, order: str) -> DataFrame:
    """``(u, v)`` from lower to higher rank, with ``rd``, the degree of ``v``, for degree order.

    In degree order every vertex sends its degree to its neighbours, one shuffle; its own degree lies with it.
    """
    if order == "id":
        return both.where("u < v")
    if order != "degree":
        raise ValueError("order must be 'degree' or 'id'")
    deg = degrees_by_vertex(both)
    sent = both.join(deg, "u").select(F.col("v").alias("to"), F.col("u").alias("v"), F.col("deg").alias("rd"))
    met = sent.join(deg.select(F.col("u").alias("to"), F.col("deg").alias("own")), "to")
    return met.where((F.col("own") < F.col("rd")) | ((F.col("own") == F.col("rd")) & (F.col("to") < F.col("v")))).select(F.col("to").alias("u"), "v", "rd")


def corners_by_vertex(both: DataFrame, order: str = "degree") -> DataFrame:
    """``(u, v, c)`` as :func:`closing_corners`, from a table of :func:`store_by_vertex`: degrees, orientation and
    adjacency share the table's partitioning, and only what goes to a neighbour is shuffled.

    Hot vertices are not dealt over several tasks here; ``order="degree"`` bounds their lists.
    """
    adj = adjacency(_ranked_by_vertex(both, order))
    if order == "degree":
        adj = _stored(adj, "adjacency")  # read by both sides of the join
    fwd = adj.select("u", F.posexplode("nbrs").alias("i", "v"), "nbrs") \
        .select("u", "v", F.slice("nbrs", F.col("i") + 2, F.size("nbrs") - F.col("i") - 1).alias("nu")).where(F.size("nu") > 0)
    return fwd.join(adj.toDF("v", "nv"), "v").select("u", "v", F.array_intersect("nu", "nv").alias("c"))


def _closed_by_vertex(both: DataFrame, order: str, counts: bool) -> DataFrame:
    """See :func:`_closed`."""
    if lists.fits(both.schema["u"].dataType) and lists.fits(both.schema["v"].dataType):
        return _by_lists(adjacency(_ranked_by_vertex(both, order)), both.count() // 2, counts)
    t = corners_by_vertex(both, order)
    return _contributions(t) if counts else t.select(F.size("c").cast("bigint").alias("cnt"))


@_freed
def triangle_counts_by_vertex(both: DataFrame, order: str = "degree") -> DataFrame:
    """``(id, count)`` for every vertex of a table of :func:`store_by_vertex` (which has no vertex without an edge)."""
    contrib = _closed_by_vertex(both, order, True)
    zeros = degrees_by_vertex(both).select(F.col("u").alias("id"), F.lit(0).cast("bigint").alias("cnt"))
    return contrib.unionByName(zeros).groupBy("id").agg(F.sum("cnt").alias("count"))


@_freed
def triangle_total_by_vertex(both: DataFrame, order: str = "degree") -> DataFrame:
    """One row ``total``."""
    return _total(_closed_by_vertex(both, order, False))


def total_from_counts(counts: DataFrame) -> DataFrame:
    """Unique triangles from per-vertex counts: ``sum(count) div 3``."""
    return counts.agg(F.expr("coalesce(sum(`count`), 0) div 3").cast("bigint").alias("total"))
