"""Oracle SQL (DuckDB dialect) for the registered queries.

Each string reads the pre-registered test tables and states the operator's
result independently of the Spark code: plain joins, aggregates and window
functions.  Column names and rounding match ``lodestar.plans.catalog``.
"""

from __future__ import annotations

from lodestar.operators import bagging, seeding
from lodestar.plans import catalog as C

KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
F1, F2, F3 = "num_feature_1", "num_feature_2", "num_feature_3"

P = f"""P AS (
  SELECT {KEY},
         l_quantity AS {F1}, l_discount AS {F2}, l_tax AS {F3},
         o_orderpriority AS category_1, l_returnflag AS category_2,
         CAST(l_quantity * (1 - l_discount) > 23 AS INTEGER) AS label
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

E = """E AS (
  SELECT DISTINCT x.l_partkey AS a, y.l_partkey AS b
  FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND x.l_partkey < y.l_partkey)"""

# Every triangle once, corners in increasing id order.
T = """T AS (
  SELECT e1.a AS x, e1.b AS y, e2.b AS z
  FROM E e1 JOIN E e2 ON e1.b = e2.a JOIN E e3 ON e3.a = e1.a AND e3.b = e2.b)"""

V = "V AS (SELECT a AS id FROM E UNION SELECT b FROM E)"

PER_VERTEX = """C AS (SELECT id, count(*) AS cnt
      FROM (SELECT x AS id FROM T UNION ALL SELECT y FROM T UNION ALL SELECT z FROM T) GROUP BY id)"""


def d(x: float) -> str:
    """A DOUBLE literal (bare decimals are DECIMAL in DuckDB)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def dist(cols, center) -> str:
    return " + ".join(f"({c} - {d(v)}) * ({c} - {d(v)})" for c, v in zip(cols, center))


def argmin_case(names) -> str:
    """Index of the smallest, lowest index on a tie."""
    k = len(names)
    if k == 1:
        return "0"
    parts = []
    for i in range(k - 1):
        conds = " AND ".join(f"{names[i]} <= {names[j]}" for j in range(i + 1, k))
        parts.append(f"WHEN {conds} THEN {i}")
    return f"CASE {' '.join(parts)} ELSE {k - 1} END"


def _points(select: str) -> str:
    return f"WITH {P} {select}"


def derive_filter(max_f2_f3: float) -> str:
    return _points(f"""
SELECT {KEY}, {F1}, {F2}, {F3}, {F1} + length(category_1) AS new_feature, category_1, label
FROM P
WHERE {F1} + length(category_1) > {d(C.FILTER_MIN_NEW_FEATURE)}
  AND {F2} + {F3} < {d(max_f2_f3)}
  AND NOT isnan({F1}) AND NOT isnan({F2}) AND NOT isnan({F3})""")


def _stats(column: str, x: str, unit: str = "1.0", digits: int = 6, mean_digits: int = 9) -> str:
    f = lambda agg, n=digits: f"round({agg}({x}) / {unit}, {n})"
    return (f"""SELECT '{column}' AS "column", count({x}) AS n, {f("avg", mean_digits)} AS mean, {f("stddev_samp")} AS std_samp,"""
            f""" {f("stddev_pop")} AS std_pop FROM P""")


def column_stats() -> str:
    return _points(" UNION ALL ".join(_stats(c, c) for c in C.FEATURES))


def column_stats_magnitudes() -> str:
    tiny = _stats("tiny", f"{F1} * {d(C.TINY)}", d(C.TINY), 4, 4)
    return _points(f"{tiny} UNION ALL {_stats('shifted', f'{F1} + {d(C.SHIFT)}', digits=4, mean_digits=4)}")


def column_stats_exact() -> str:
    parts = [_stats("plain", F1, digits=10, mean_digits=10), _stats("tiny", f"{F1} * {d(C.TINY)}", d(C.TINY), 10, 10), _stats("large", f"{F2} * {d(C.SHIFT)}", d(C.SHIFT), 10, 10)]
    return _points(" UNION ALL ".join(parts))


V_VALID = """V AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) = 0)"""

FAR = "list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"


def _vector_assign(points: str, centers: str) -> str:
    """Each point's nearest center, the lowest on a tie."""
    return f"(SELECT vec_id, v, cluster FROM (SELECT vec_id, v, cluster, row_number() OVER (PARTITION BY vec_id ORDER BY {FAR}, cluster) AS r FROM {points}, {centers}) WHERE r = 1)"


def _first_vectors(k: int) -> str:
    return f"(SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster, v AS c FROM V ORDER BY vec_id LIMIT {k})"


def assign_many() -> str:
    return f"WITH {V_VALID}, C AS {_first_vectors(C.MANY_CENTERS)}, A AS {_vector_assign('V', 'C')} SELECT e.vec_id, A.cluster FROM embeddings e LEFT JOIN A ON e.vec_id = A.vec_id"


def vector_stats() -> str:
    return f"WITH {V_VALID} SELECT CAST(j - 1 AS INTEGER) AS dimension, round(avg(v[j]), 9) AS mean, round(stddev_pop(v[j]), 9) AS std_pop FROM V, range(1, 65) r(j) GROUP BY j"


def lloyd_vectors() -> str:
    ctes = [V_VALID, f"C0 AS {_first_vectors(C.VECTOR_K)}"]
    for i in range(C.LLOYD_ITERS):
        ctes += [f"A{i} AS {_vector_assign('V', f'C{i}')}",
                 f"M{i} AS (SELECT cluster, j, avg(v[j]) AS m FROM A{i}, range(1, 65) r(j) GROUP BY cluster, j)",
                 f"C{i + 1} AS (SELECT C0.cluster, list(coalesce(m, 0.0) ORDER BY r.j) AS c FROM C0 CROSS JOIN range(1, 65) r(j)"
                 f" LEFT JOIN M{i} ON M{i}.cluster = C0.cluster AND M{i}.j = r.j GROUP BY C0.cluster)"]
    return f"WITH {', '.join(ctes)} SELECT cluster, CAST(j - 1 AS INTEGER) AS dimension, round(c[j], 6) AS value FROM C{C.LLOYD_ITERS}, range(1, 65) r(j)"


def lloyd_converged() -> str:
    """One feature and two centers: steps until the centers no longer move (the ones before the last step count)."""
    (a,), (b,) = C.CONVERGE_INIT
    near = "abs({0} - {1}) <= CAST(1e-8 AS DOUBLE) + CAST(1e-9 AS DOUBLE) * abs({1})"
    mean = lambda op: f"coalesce((SELECT avg(x) FROM X WHERE (x - s.a) * (x - s.a) {op} (x - s.b) * (x - s.b)), 0.0)"
    return f"""WITH RECURSIVE {P}, X AS MATERIALIZED (SELECT {F1} AS x FROM P),
S(i, a, b, na, nb) AS (SELECT 0, {d(a)}, {d(b)}, {d(a)}, {d(b)} UNION ALL
  SELECT i + 1, na, nb, {mean("<=").replace("s.a", "t.na").replace("s.b", "t.nb")}, {mean(">").replace("s.a", "t.na").replace("s.b", "t.nb")}
  FROM S t WHERE i < {C.CONVERGE_ITERS} AND (i = 0 OR NOT ({near.format("a", "na")} AND {near.format("b", "nb")}))),
L AS (SELECT * FROM S ORDER BY i DESC LIMIT 1)
SELECT c AS cluster, round(CASE WHEN c = 0 THEN a ELSE b END, 6) AS center, CAST(i AS INTEGER) AS iterations, {near.format("a", "na")} AND {near.format("b", "nb")} AS converged
FROM L, (VALUES (CAST(0 AS INTEGER)), (CAST(1 AS INTEGER))) k(c)"""


def seeded(what: str) -> str:
    """k-means|| with two steps, then Lloyd's steps."""
    seed, l = C.BAG_SEED, 2 * C.LLOYD_K
    xs, stats = ["x1", "x2", "x3"], ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(C.FEATURES, 1))
    gap = lambda p, c: " + ".join(f"({p}.{x} - {c}.{x}) * ({p}.{x} - {c}.{x})" for x in xs)
    order = "PARTITION BY " + KEY
    ctes = [P, f"st AS (SELECT {stats} FROM P)",
            f"S AS MATERIALIZED (SELECT {KEY}, " + ", ".join(f"({c} - m{i}) / s{i} AS x{i}" for i, c in enumerate(C.FEATURES, 1)) + " FROM P, st)",
            f"K0 AS MATERIALIZED (SELECT 0 AS step, * FROM S ORDER BY md5('{seed}:first:' || concat_ws('|', {KEY})) LIMIT 1)"]
    for t in range(2):
        u = uniform(f"step{t}", seed)
        ctes += [f"D{t} AS MATERIALIZED (SELECT {', '.join('S.' + k for k in KEY.split(', '))}, S.x1, S.x2, S.x3, min({gap('S', 'k')}) AS d2 FROM S, K{t} k GROUP BY ALL)",
                 f"K{t + 1} AS MATERIALIZED (SELECT * FROM K{t} UNION ALL SELECT {t + 1}, {KEY}, x1, x2, x3 FROM D{t} WHERE {u} < least({d(1.0)}, {d(l)} * d2 / (SELECT sum(d2) FROM D{t})))"]
    ctes += [f"K AS MATERIALIZED (SELECT row_number() OVER (ORDER BY step, {KEY}) - 1 AS i, x1, x2, x3 FROM K2)",
             f"N AS (SELECT i, count(*) AS w FROM (SELECT k.i, row_number() OVER ({order.replace('l_', 'S.l_')} ORDER BY {gap('S', 'k')}, k.i) AS r FROM S, K k) WHERE r = 1 GROUP BY i)",
             "W AS MATERIALIZED (SELECT K.i, x1, x2, x3, CAST(coalesce(w, 0) AS DOUBLE) AS w FROM K LEFT JOIN N ON N.i = K.i)"]
    pick = lambda share, n: (f"(SELECT * FROM (SELECT i, x1, x2, x3, sum(share) OVER (ORDER BY i) AS up, sum(share) OVER () AS total FROM (SELECT *, {share} AS share FROM W))"  # noqa: E731
                             f" WHERE up > {d(seeding.drawn(seed, f'reduce{n}'))} * total ORDER BY i LIMIT 1)")
    ctes += [f"R0 AS MATERIALIZED {pick('w', 0)}", f"R1 AS MATERIALIZED {pick('w * (' + gap('W', '(SELECT * FROM R0)').replace('(SELECT * FROM R0).', 'r0_') + ')', 1)}"]
    ctes[-1] = ctes[-1].replace("FROM W)", "FROM W, (SELECT x1 AS r0_x1, x2 AS r0_x2, x3 AS r0_x3 FROM R0))")
    ctes.append("C0 AS (SELECT CAST(0 AS INTEGER) AS cluster, x1, x2, x3 FROM R0 UNION ALL SELECT CAST(1 AS INTEGER), x1, x2, x3 FROM R1)")
    return _lloyd_steps(ctes, xs, C.LLOYD_K, C.LLOYD_ITERS, what)


def assign_array() -> str:
    ds = ", ".join("list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))".replace("c[i]", f"([{', '.join(map(repr, c))}])[i]")
                   + f" AS d{j}" for j, c in enumerate(C.ARRAY_CENTERS))
    names = [f"d{j}" for j in range(len(C.ARRAY_CENTERS))]
    return f"SELECT vec_id, {argmin_case(names)} AS cluster FROM (SELECT vec_id, {ds} FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))"


def rule_metrics() -> str:
    """AUC from mean ranks, as ties count half."""
    return _points(f"""
, S AS (SELECT label AS y, {F1} / {d(51.0)} AS p1, CAST({F1} / {d(51.0)} > {d(0.5)} AS INTEGER) AS prediction FROM P),
R AS (SELECT *, rank() OVER (ORDER BY p1) + (count(*) OVER (PARTITION BY p1) - 1) / {d(2.0)} AS r,
             least(greatest(p1, {d(1e-15)}), {d(1.0)} - {d(1e-15)}) AS p FROM S)
SELECT count(*) AS n, round(avg(CAST(prediction = y AS DOUBLE)), 6) AS accuracy,
       round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS log_loss,
       round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / {d(2.0)}) / (sum(y) * {d(1.0)} * sum(1 - y)), 6) AS auc FROM R""")


def phase_report() -> str:
    lloyd = ["load", "prepare", "train", *[f"iteration_{i + 1}" for i in range(C.LLOYD_ITERS)], "operate", "total"]
    tri = ["load", "prepare", "execute", "operate", "total"]
    rows = ", ".join(f"('{j}', '{p}', 'ok', CAST(NULL AS VARCHAR))" for j, ps in (("lloyd", lloyd), ("triangles", tri)) for p in ps)
    return f"""WITH {P}, {E}, {T}, {V}
SELECT * FROM (VALUES {rows}) t(job, phase, status, value)
UNION ALL SELECT 'lloyd', 'points', 'ok', CAST(count(*) AS VARCHAR) FROM P
UNION ALL SELECT 'triangles', 'vertices', 'ok', CAST(count(*) AS VARCHAR) FROM V
UNION ALL SELECT 'triangles', 'unique_triangles', 'ok', CAST(count(*) AS VARCHAR) FROM T"""


def success_reports() -> str:
    phases = ", ".join(f"('{p}', '')" for p in ("load", "prepare", "execute", "operate", "total"))
    one = (f"SELECT 'triangles' AS job, phase, result FROM (SELECT * FROM (VALUES {phases}) t(phase, result)"
           " UNION ALL SELECT 'vertices', CAST(count(*) AS VARCHAR) FROM V UNION ALL SELECT 'unique_triangles', CAST(count(*) AS VARCHAR) FROM T)")
    return f"WITH {P}, {E}, {T}, {V}, R AS ({one}) SELECT * FROM R UNION ALL SELECT * FROM R"


def error_reports() -> str:
    text = f"' points have a null or NaN in {', '.join(C.FEATURES)}; handle_invalid=''skip'' leaves them out'"
    return _points(f"""SELECT 'lloyd' AS job, 'load' AS phase, '' AS result UNION ALL SELECT 'lloyd', 'total', ''
UNION ALL SELECT 'lloyd', 'prepare', 'ERROR ValueError: ' || CAST(count(*) AS VARCHAR) || {text} FROM P WHERE NOT l_linenumber > 1""")


def standardized(cols, with_mean: bool, std: str, source: str = "P") -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, {std}({c}) AS s_{c}" for c in cols)
    outs = ", ".join(
        f"round(CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c}{f' - m_{c}' if with_mean else ''}) / s_{c} END, 6) AS {c}"
        for c in cols)
    return f"st AS (SELECT {stats} FROM {source}) SELECT {KEY}, {outs} FROM {source}, st"


def std_only() -> str:
    cols = [*C.FEATURES, "new_feature"]
    return f"""WITH {P}, Q AS (
  SELECT {KEY}, {F1}, {F2}, {F3}, {F1} + length(category_1) AS new_feature FROM P
  WHERE {F1} + length(category_1) > {d(C.FILTER_MIN_NEW_FEATURE)} AND {F2} + {F3} < {d(C.FILTER_MAX_F2_F3)}
    AND NOT isnan({F1}) AND NOT isnan({F2}) AND NOT isnan({F3})),
{standardized(cols, False, "stddev_samp", "Q")}"""


def assign_fixed() -> str:
    ds = ", ".join(f"{dist(C.FEATURES, c)} AS d{i}" for i, c in enumerate(C.FIXED_CENTERS))
    names = [f"d{i}" for i in range(len(C.FIXED_CENTERS))]
    return _points(f"SELECT {KEY}, {argmin_case(names)} AS cluster FROM (SELECT *, {ds} FROM P)")


def update_empty() -> str:
    cs = C.EMPTY_CLUSTER_CENTERS
    ds = ", ".join(f"{dist(C.FEATURES, c)} AS d{i}" for i, c in enumerate(cs))
    names = [f"d{i}" for i in range(len(cs))]
    ks = ", ".join(f"({i})" for i in range(len(cs)))
    means = ", ".join(f"avg({c}) AS {c}" for c in C.FEATURES)
    outs = ", ".join(f"round(coalesce(M.{c}, 0.0), 6) AS {c}" for c in C.FEATURES)
    return f"""WITH {P},
A AS (SELECT *, {argmin_case(names)} AS cluster FROM (SELECT *, {ds} FROM P)),
M AS (SELECT cluster, {means}, count(*) AS n FROM A GROUP BY cluster),
K AS (SELECT * FROM (VALUES {ks}) t(cluster))
SELECT K.cluster, {outs}, coalesce(M.n, 0) AS n FROM K LEFT JOIN M ON K.cluster = M.cluster"""


def lloyd(k: int, iters: int, what: str) -> str:
    """Unrolled Lloyd iterations: standardize (population std), first k rows
    by key as centers, ``iters`` assign + mean steps; a cluster without
    points gets the zero vector."""
    xs = ["x1", "x2", "x3"]
    digits = f"%.{C.LLOYD_DIGITS - 1}e"
    ctes = [P,
            "st AS (SELECT " + ", ".join(
                f"CAST(printf('{digits}', avg({c})) AS DOUBLE) AS m{i}, CAST(printf('{digits}', stddev_pop({c})) AS DOUBLE) AS s{i}"
                for i, c in enumerate(C.FEATURES, 1)) + " FROM P)",
            f"S AS (SELECT {KEY}, " + ", ".join(f"({c} - m{i}) / s{i} AS x{i}"
                                                for i, c in enumerate(C.FEATURES, 1)) + " FROM P, st)",
            f"C0 AS (SELECT * FROM (SELECT x1, x2, x3, CAST(row_number() OVER (ORDER BY {KEY}) - 1 AS INTEGER)"
            f" AS cluster FROM S) WHERE cluster < {k})"]

    return _lloyd_steps(ctes, xs, k, iters, what)


def _lloyd_steps(ctes: list[str], xs: list[str], k: int, iters: int, what: str) -> str:
    """Steps on the points ``S`` from the centers ``C0``."""
    ctes = list(ctes)

    def pivot(i):
        cols = ", ".join(f"coalesce(max(CASE WHEN cluster = {j} THEN {x} END), 0.0) AS c{j}_{x}"
                         for j in range(k) for x in xs)
        return f"Z{i} AS (SELECT {cols} FROM C{i})"

    def assign(i):
        ds = ", ".join(" + ".join(f"(S.{x} - c{j}_{x}) * (S.{x} - c{j}_{x})" for x in xs) + f" AS d{j}"
                       for j in range(k))
        return (f"A{i} AS (SELECT x1, x2, x3, {argmin_case([f'd{j}' for j in range(k)])} AS cluster "
                f"FROM (SELECT S.x1, S.x2, S.x3, {ds} FROM S, Z{i}))")

    for i in range(iters):
        ctes += [pivot(i), assign(i),
                 f"C{i + 1} AS (SELECT cluster, avg(x1) AS x1, avg(x2) AS x2, avg(x3) AS x3 FROM A{i} GROUP BY cluster)"]
    ctes += [pivot(iters), assign(iters)]
    head = "WITH " + ",\n".join(ctes)
    if what == "sizes":
        return f"{head}\nSELECT cluster, count(*) AS n FROM A{iters} GROUP BY cluster ORDER BY cluster"
    rows = " UNION ALL ".join(
        f"SELECT CAST({j} AS INTEGER) AS cluster, "
        + ", ".join(f"round(c{j}_{x}, 6) AS {c}" for x, c in zip(xs, C.FEATURES)) + f" FROM Z{iters}"
        for j in range(k))
    return f"{head}\n{rows}"


HASH_BUCKET = (f"CAST(CAST('0x' || substr(md5(concat_ws('|', {KEY})), 1, 8) AS BIGINT) % 100 AS INTEGER)")


def uniform(salt: str, seed: int) -> str:
    digest = f"md5('{seed}:{salt}:' || concat_ws('|', {KEY}))"
    return f"((CAST(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) AS DOUBLE) + {d(0.5)}) / {d(4294967296.0)})"


def bag_weight(tree: int, rate: float, replacement: bool) -> str:
    u = uniform(f"tree{tree}", C.BAG_SEED)
    if not replacement:
        return f"CAST({u} < {d(rate)} AS INTEGER)"
    return "(" + " + ".join(f"CAST({u} >= {d(p)} AS INTEGER)" for p in bagging.poisson_steps(rate)) + ")"


def bag_weights() -> str:
    outs = [f"{bag_weight(t, 1.0, True)} AS w{t}" for t in range(4)] + [f"{bag_weight(t, C.BAG_RATE, False)} AS b{t}" for t in range(4)]
    return _points(f"SELECT {KEY}, {', '.join(outs)} FROM P")


def stumps(trees: int, rate: float, replacement: bool, fraction: float, out: str) -> str:
    """Trees of depth 1: quantile bins of the rows of least md5, and per tree the cut with the largest
    gain of weighted gini impurity (the first feature and cut of several); two leaves of one class are merged."""
    cols = C.FOREST_FEATURES
    q = derive_filter(C.FILTER_MAX_F2_F3)
    ctes = [f"Q AS MATERIALIZED (SELECT *, {HASH_BUCKET} < 70 AS t FROM ({q}))",
            f"H AS (SELECT {', '.join(cols)} FROM Q WHERE t ORDER BY md5(concat_ws('|', {KEY})) LIMIT {bagging.BIN_SAMPLE})"]
    for j, c in enumerate(cols):
        ctes += [f"L{j} AS (SELECT list({c} ORDER BY {c}) AS l FROM H)",
                 f"X{j} AS (SELECT list(DISTINCT v ORDER BY v) AS l FROM (SELECT l[i * len(l) // {C.BAG_BINS} + 1] AS v FROM L{j}, range(1, {C.BAG_BINS}) r(i)))"]
    bins = ", ".join(f"len(list_filter((SELECT l FROM X{j}), lambda x: x <= {c})) AS b{j}" for j, c in enumerate(cols))
    ctes.append(f"Z AS MATERIALIZED (SELECT {KEY}, t, label, {bins} FROM Q)")
    for t, names in enumerate(bagging.tree_features(cols, trees, fraction, C.BAG_SEED)):
        w = bag_weight(t, rate, replacement)
        counts = " UNION ALL ".join(f"SELECT {cols.index(c)} AS f, b{cols.index(c)} AS b, CAST(sum(w) AS DOUBLE) AS n, CAST(sum(w * label) AS DOUBLE) AS p FROM W{t} GROUP BY b{cols.index(c)}"
                                    for c in names)
        gini = lambda n, p: f"(1 - ({p} / {n}) * ({p} / {n}) - (1 - {p} / {n}) * (1 - {p} / {n}))"
        ctes += [f"W{t} AS MATERIALIZED (SELECT *, {w} AS w FROM Z WHERE t)",
                 f"G{t} AS (SELECT f, b, sum(n) OVER (PARTITION BY f ORDER BY b) AS n, sum(p) OVER (PARTITION BY f ORDER BY b) AS p,"
                 f" sum(n) OVER (PARTITION BY f) AS nn, sum(p) OVER (PARTITION BY f) AS pp FROM ({counts}) WHERE n > 0)",
                 f"A{t} AS (SELECT f, b, p / n AS lo, (pp - p) / (nn - n) AS hi, pp / nn AS whole FROM G{t} WHERE n < nn ORDER BY "
                 f"round({gini('nn', 'pp')} - n / nn * {gini('n', 'p')} - (nn - n) / nn * {gini('(nn - n)', '(pp - p)')}, 12) DESC, f, b LIMIT 1)",
                 f"S{t} AS (SELECT f, b, CASE WHEN same THEN whole ELSE lo END AS lo, CASE WHEN same THEN whole ELSE hi END AS hi"
                 f" FROM (SELECT *, (lo > 0.5) = (hi > 0.5) AS same FROM A{t}))"]
    one = lambda t: (f"(SELECT CASE WHEN (CASE S{t}.f " + " ".join(f"WHEN {j} THEN b{j}" for j in range(len(cols))) + f" END) <= S{t}.b THEN S{t}.lo ELSE S{t}.hi END FROM S{t})")
    ctes.append(f"R AS (SELECT {KEY}, label, {', '.join(f'{one(t)} AS p{t}' for t in range(trees))} FROM Z WHERE NOT t)")
    mean = lambda t: "(" + " + ".join(f"p{i}" for i in range(t + 1)) + f") / {t + 1}"
    head = "WITH " + ",\n".join(ctes)
    if out == "scores":
        return f"{head}\nSELECT {KEY}, CAST({mean(trees - 1)} > 0.5 AS INTEGER) AS prediction, round({mean(trees - 1)}, 9) AS p1 FROM R"
    clipped = lambda t: f"least(greatest({mean(t)}, {d(1e-15)}), {d(1.0)} - {d(1e-15)})"
    return head + "\n" + " UNION ALL ".join(
        f"SELECT CAST({t + 1} AS INTEGER) AS trees, count(*) AS n, round(avg(CAST(CAST({mean(t)} > 0.5 AS INTEGER) = label AS DOUBLE)), 6) AS accuracy,"
        f" round(avg(-(label * ln({clipped(t)}) + (1 - label) * ln(1 - {clipped(t)}))), 6) AS log_loss FROM R" for t in range(trees))


def edges_cast() -> str:
    return """WITH R AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN CAST(l_partkey AS VARCHAR) || l_returnflag
              ELSE CAST(l_partkey AS VARCHAR) END AS u,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN CAST(l_suppkey + 3000000000 AS VARCHAR)
              ELSE CAST(l_suppkey AS VARCHAR) END AS v
  FROM lineitem)
SELECT TRY_CAST(trim(u) AS BIGINT) AS src, TRY_CAST(trim(v) AS BIGINT) AS dst FROM R
WHERE TRY_CAST(trim(u) AS BIGINT) IS NOT NULL AND TRY_CAST(trim(v) AS BIGINT) IS NOT NULL"""


def tri_counts(where: str = "") -> str:
    return f"""WITH {E}, {T}, {V}, {PER_VERTEX}
SELECT V.id, coalesce(C.cnt, 0) AS "count" FROM V LEFT JOIN C ON V.id = C.id {where}"""


TRI_TOTAL = f"WITH {E}, {T} SELECT count(*) AS total FROM T"


def synth() -> str:
    from lodestar.sources import synth as S
    seed = 42

    def u(k):
        dig = "abc"[k // 4]
        return (f"((CAST(CAST('0x' || substr(d{dig}, {8 * (k % 4) + 1}, 8) AS BIGINT) AS DOUBLE) + {d(0.5)})"
                f" / {d(4294967296.0)})")

    colours = "[" + ", ".join(f"'{c}'" for c in S.COLOURS) + "]"
    letters = "[" + ", ".join(f"'{c}'" for c in S.LETTERS) + "]"
    feats = []
    r1, r2 = f"sqrt({d(-2.0)} * ln(u3))", f"sqrt({d(-2.0)} * ln(u5))"
    z = [f"{r1} * cos({d(2 * 3.141592653589793)} * u4)", f"{r1} * sin({d(2 * 3.141592653589793)} * u4)",
         f"{r2} * cos({d(2 * 3.141592653589793)} * u6)"]
    for j in range(3):
        feats.append(f"round(CASE WHEN cls = 1 THEN {d(S.MEANS[1][j])} ELSE {d(S.MEANS[0][j])} END + {z[j]}, 6)"
                     f" AS num_feature_{j + 1}")
    us = ", ".join(f"{u(k)} AS u{k}" for k in range(12))
    return f"""WITH ids AS (SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS id FROM lineitem),
D AS (SELECT id, md5('{seed}:' || id || ':a') AS da, md5('{seed}:' || id || ':b') AS db,
             md5('{seed}:' || id || ':c') AS dc FROM ids),
U AS (SELECT id, {us} FROM D),
L AS (SELECT *, CASE WHEN u0 < {d(0.5)} THEN 1 ELSE 0 END AS cls FROM U)
SELECT id, {", ".join(feats)},
       ({colours})[CAST(floor(u7 * {len(S.COLOURS)}) AS INTEGER) + 1] AS category_1,
       ({letters})[CAST(floor(u8 * {len(S.LETTERS)}) AS INTEGER) + 1] AS category_2,
       CAST(CASE WHEN u1 < {d(S.FLIP_FRACTION)} THEN (CASE WHEN u2 < {d(0.5)} THEN 1 ELSE 0 END) ELSE cls END
            AS INTEGER) AS label
FROM L"""


POINT_COLS = f"{F1}, {F2}, {F3}, category_1, category_2, label"


def oracle_sql() -> dict[str, str]:
    q = {
        "points_project": _points(f"SELECT {KEY}, {F1}, {F2}, {F3}, label FROM P"),
        "points_derive_filter": derive_filter(C.FILTER_MAX_F2_F3),
        "points_derive_filter_original": derive_filter(C.FILTER_MAX_F2_F3_ORIGINAL),
        "label_counts": _points("SELECT label, count(*) AS n FROM P GROUP BY label ORDER BY label"),
        "column_stats": column_stats(),
        "standardize_sample": f"WITH {P}, " + standardized(C.FEATURES, True, "stddev_samp"),
        "standardize_population": f"WITH {P}, " + standardized(C.FEATURES, True, "stddev_pop"),
        "standardize_std_only": std_only(),
        "assign_nearest_fixed": assign_fixed(),
        "update_centers_empty": update_empty(),
        "lloyd_centers": lloyd(C.LLOYD_K, C.LLOYD_ITERS, "centers"),
        "lloyd_cluster_sizes": lloyd(C.LLOYD_K, C.LLOYD_ITERS, "sizes"),
        "split_hash": _points(f"SELECT {KEY}, {HASH_BUCKET} AS bucket, {HASH_BUCKET} < 70 AS is_train FROM P"),
        "split_tail": _points(f"SELECT {KEY}, row_number() OVER (ORDER BY {KEY}) <= "
                              f"floor(count(*) OVER () * {d(0.7)}) AS is_train FROM P"),
        "column_stats_magnitudes": column_stats_magnitudes(),
        "column_stats_exact": column_stats_exact(),
        "standardize_exact": f"WITH {P}, " + standardized(C.FEATURES, True, "stddev_pop"),
        "repartitioned": _points(f"SELECT {KEY}, {F1}, {F2}, {F3}, label FROM P"),
        "assign_nearest_array": assign_array(),
        "assign_nearest_many": assign_many(),
        "vector_stats": vector_stats(),
        "lloyd_vectors": lloyd_vectors(),
        "lloyd_converged": lloyd_converged(),
        "kmeans_seeded_centers": seeded("centers"),
        "kmeans_seeded_sizes": seeded("sizes"),
        "kmeans_checks": _points("SELECT count(*) AS n, CAST(0 AS BIGINT) AS not_nearest FROM P"),
        "split_random_cover": _points(f"SELECT {KEY} FROM P"),
        "split_tail_ties": _points(f", R AS (SELECT {F1}, row_number() OVER (ORDER BY {F1}) <= floor(count(*) OVER () * {d(0.7)}) AS t FROM P) "
                                   f"SELECT {F1}, count(*) AS n, CAST(sum(CAST(t AS BIGINT)) AS BIGINT) AS n_train FROM R GROUP BY {F1}"),
        "split_tail_nulls": _points(f"SELECT {KEY}, row_number() OVER (ORDER BY CASE WHEN l_linenumber > 1 THEN l_linenumber END NULLS FIRST, "
                                    f"l_orderkey, l_partkey, l_suppkey) <= floor(count(*) OVER () * {d(0.7)}) AS is_train FROM P"),
        "model_roundtrip": f"WITH Q AS ({derive_filter(C.FILTER_MAX_F2_F3)}) SELECT count(*) AS n, CAST(0 AS BIGINT) AS mismatches FROM Q WHERE {HASH_BUCKET} >= 70",
        "rule_metrics": rule_metrics(),
        "forest_bag_weights": bag_weights(),
        "stump_scores": stumps(1, 1.0, False, 1.0, "scores"),
        "bagged_stump_scores": stumps(4, C.BAG_RATE, False, 0.5, "scores"),
        "forest_staged_metrics": stumps(4, 1.0, True, 0.5, "metrics"),
        "phase_report": phase_report(),
        "success_reports": success_reports(),
        "error_reports": error_reports(),
        "split_seeded": _points(f"SELECT {KEY}, {uniform('split', C.BAG_SEED)} < {d(0.7)} AS is_train FROM P"),
        "edge_list_short_lines": "SELECT CAST(l_partkey AS BIGINT) AS src, CAST(l_suppkey AS BIGINT) AS dst FROM lineitem WHERE l_linenumber <> 1",
        "edges_cast": edges_cast(),
        "graph_vertices": f"WITH {E} SELECT a AS id FROM E UNION SELECT b FROM E",
        "graph_canonical_edges": f"WITH {E} SELECT a, b FROM E",
        "triangle_counts": tri_counts(),
        "triangle_counts_raw": tri_counts(),
        "triangle_counts_subset": tri_counts(
            f"WHERE V.id IN (SELECT p_partkey FROM part WHERE p_size <= {C.SUBSET_MAX_SIZE})"),
        "triangle_total": TRI_TOTAL,
        "triangle_total_id_order": TRI_TOTAL,
        "triangle_total_from_counts": TRI_TOTAL,
        "triangle_total_colours": TRI_TOTAL,
        "degrees_stored": f"WITH {E} SELECT id, count(*) AS deg FROM (SELECT a AS id FROM E UNION ALL SELECT b FROM E) GROUP BY id",
        "triangle_counts_stored": tri_counts(),
        "triangle_total_stored": TRI_TOTAL,
        "triangle_counts_colours": tri_counts(),
        "triangle_counts_subset_colours": tri_counts(f"WHERE V.id IN (SELECT p_partkey FROM part WHERE p_size <= {C.SUBSET_MAX_SIZE})"),
        "csv_roundtrip": _points(f"SELECT {POINT_COLS} FROM P"),
        "csv_inferred_roundtrip": _points(f"SELECT {POINT_COLS} FROM P"),
        "edgelist_roundtrip": f"WITH {E} SELECT a AS src, b AS dst FROM E",
        "edges_tsv_roundtrip": f"WITH {E} SELECT a AS src, b AS dst FROM E",
        "synth_points": synth(),
    }
    return q
