"""The registered queries of this subpackage, each over its whole table, and the SQL that states the same result."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import (alignment, conversation_repair, decontaminate, embedding_dedup, language_model, ngram_join, packing, quality, records,
                          secret_scan, substring_dedup, token_counts, url_filter)
from lodestar.sources.tables import table

#: Fixed values of the url query: (host, path, verdict).
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def tokenizer_file(name: str) -> str:
    """Place of an installed vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def remainder(modulus: int):
    """crc32 of doc_id as text, modulo ``modulus`` (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


#: Least score of a document that passes the quality classifier.
PASS_SCORE = 0.3


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), training=remainder(5) != 0)
    out = quality.score_documents(docs, model, keep=["doc_id"], text="text")
    return out.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= PASS_SCORE).cast("int").alias("predicted"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeated(table(spark, sf_dir, "documents"), size=35, keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(spark, table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=2)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = decontaminate.hit_words()
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)
    return out.select("vec_id", "n_links", "component_id", "kept")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {_RULE_VALUES} AS t(host, path, verdict)")
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, scores = token_counts.zipf_pieces(tokenizer_file("piece_bpe_32k.model"))
    return token_counts.count_pieces(table(spark, sf_dir, "documents"), pieces, scores, keep=["doc_id"])


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1)


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (remainder(7) == 2).alias("held_out"))
    return language_model.score_texts(docs, training=~F.col("held_out"), keep=["doc_id", "held_out"])


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.ngram_components(docs, size=4, threshold=85).select("doc_id", "n_shingles", "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(secret_scan.find_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"]), keep=["doc_id"])


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = alignment.Files(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    return alignment.align_documents(table(spark, sf_dir, "documents"), files, keep=["doc_id"])


QUERIES = {f.__name__: f for f in (op1_quality, op2_substring_dedup, op3_token_records, op4_decontamination, op5_embedding_dedup, op6_url_filter,
                                   op7_token_counts, op8_packing, op9_language_model, op10_ngram_join,
                                   op11_conversation_repair, op12_secret_scan, op13_token_alignment)}

_RULE_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

_WORDS4 = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Words between white space, and with A-Z lower-cased.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _repair_moves() -> str:
    """Every way past one message, with at most one message inserted before it: state before and after, letters, cost, the initial that
    it asks for, the one that it rules out, and whether the message stays.  States: start, after the system's, assistant's turn, user's turn."""
    turn, follow = {0: "u", 1: "u", 2: "a", 3: "u"}, {0: 2, 1: 2, 2: 3, 3: 2}
    rows = []
    for state in turn:
        for at, letters, cost in ((state, "", 0), (follow[state], "I", 5)):
            rows.append((state, at, letters + "D", cost + 2, "", "", 0))
            rows.append((state, follow[at], letters + "K", cost, turn[at], "", 1))
            rows.append((state, follow[at], letters + "R", cost + 1, "", turn[at], 1))
            if at == 0:
                rows.append((state, 1, letters + "K", cost, "s", "", 1))
    return ", ".join(map(str, rows))


_REPAIR_ORACLE = f"""
WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN (c & 1) = 1
                              THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
k AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             xor(list_reduce([4294967295] || list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT)),
                             lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS r FROM k, crc),
x AS (SELECT conv_id, turn, CASE WHEN r = 4 THEN 'user' ELSE role END AS role, CASE WHEN r = 1 THEN '' WHEN r = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(range(CASE WHEN r = 3 THEN 2 ELSE 1 END)) AS copy FROM d WHERE r <> 0),
o AS (SELECT conv_id, turn, role, text, substr(role, 1, 1) AS ini, regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS solid,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM x),
f AS MATERIALIZED (SELECT *, solid = '' AS blank, solid <> '' AND again AS dup, solid <> '' AND NOT again AND right(solid, 1) NOT IN ('.', '!', '?') AS cut
      FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                   coalesce(lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au'), false) AS bad FROM o)),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
             count(*) FILTER (cut) AS truncated, count(*) FILTER (bad) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
m(s, after, letters, cost, want, avoid, stays) AS (VALUES {_repair_moves()}),
w(conv_id, i, s, best) AS (SELECT conv_id, CAST(0 AS BIGINT), 0, '00000000' FROM g UNION ALL
      SELECT w.conv_id, f.i, m.after, min(printf('%08d', CAST(substr(w.best, 1, 8) AS INTEGER) + m.cost + CASE WHEN m.stays = 1 AND f.cut THEN 5 ELSE 0 END) || substr(w.best, 9) || m.letters)
      FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
      JOIN m ON m.s = w.s AND (m.stays = 0 OR NOT (f.blank OR f.dup)) AND (m.want = '' OR m.want = f.ini) AND (m.avoid = '' OR m.avoid <> f.ini) GROUP BY w.conv_id, f.i, m.after),
e AS (SELECT g.conv_id, min(CASE WHEN s = 2 THEN printf('%08d', CAST(substr(best, 1, 8) AS INTEGER) + 5) || substr(best, 9) || 'I' ELSE best END) AS best
      FROM g JOIN w ON g.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = g.n WHERE s <> 1 GROUP BY g.conv_id),
l AS (SELECT conv_id, p, substr(best, 8 + p, 1) AS letter FROM (SELECT conv_id, best, unnest(range(1, length(best) - 7)) AS p FROM e)),
a AS (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i FROM l),
b AS (SELECT a.conv_id, a.p, a.letter, CASE WHEN a.letter <> 'I' THEN f.role END AS role, CASE WHEN a.letter = 'I' THEN '' ELSE f.text END AS text,
             row_number() OVER (PARTITION BY a.conv_id ORDER BY a.p) - 1 AS q FROM a LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM a.conv_id AND f.i = a.i WHERE a.letter <> 'D'),
c AS (SELECT *, max(CASE WHEN q = 0 AND letter = 'K' AND substr(role, 1, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS system FROM b),
t AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (q - system) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS body FROM c GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(substr(e.best, 1, 8), '0') AS BIGINT) AS cost, coalesce(substr(e.best, 9), '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM ids.conv_id"""

_EITHER_CASE = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
#: The texts that the patterns of a scan match, and for runs of a class those of a window's length or more.
_SECRET_PATTERNS = {"assign": f"(?:{_EITHER_CASE})[\"'']?\\x20*[:=]\\x20*[\"'']?[A-Za-z0-9+/_.=-]+", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]{24,}",
                    **{c.kind: f"[{re.escape(c.characters.decode())}]{{{c.window},}}" for c in secret_scan.CLASSES}}


def _secret_oracle() -> str:
    kinds = list(_SECRET_PATTERNS)
    found = " UNION ALL ".join(f"SELECT rid, {i} AS kind, regexp_extract_all(t, '{p}') AS hits, string_split_regex(t, '{p}') AS gaps FROM d" for i, p in enumerate(_SECRET_PATTERNS.values()))
    value = f"regexp_extract(hit, '^(?:{_EITHER_CASE})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)$', 1)"
    parts = " OR ".join(f"contains(lower(hit), '{p.lower()}')" for p in secret_scan.ALLOWED_PARTS)
    forms = " OR ".join(f"regexp_full_match(hit, '{f}')" for f in secret_scan.ALLOWED_FORMS)
    classes = " UNION ALL ".join(
        f"SELECT rid, kind, a, {c.window} AS w, unnest(list_filter(range(0, length(hit) - {c.window - 1}), lambda i: list_sum(list_transform("
        f"map_values(list_aggregate(string_split(hit[i + 1:i + {c.window}], ''), 'histogram')), lambda n: ([{', '.join(map(str, secret_scan.entropy_units(c.window)[1:]))}])[CAST(n AS BIGINT)])) "
        f"<= {secret_scan.most_units(c.window, c.bits)})) AS i FROM s WHERE kind = {len(secret_scan.KINDS) + j} AND NOT ({parts} OR {forms})" for j, c in enumerate(secret_scan.CLASSES))
    shown = lambda where: f"coalesce(string_agg(name || ':' || a || ':' || b, ',' ORDER BY a, kind) {where}, '')"
    base = len(secret_scan.KINDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
p AS (SELECT rid, kind, hit, k, length(gap) AS g FROM (SELECT rid, kind, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, unnest(range(len(hits))) AS k FROM ({found}))),
s AS MATERIALIZED (SELECT rid, kind, hit, CAST(sum(g + length(hit)) OVER (PARTITION BY rid, kind ORDER BY k) AS BIGINT) - length(hit) AS a FROM p),
b AS (SELECT rid, kind, a, a + length(hit) AS b FROM s WHERE (kind = 0 AND length({value}) >= 6) OR (kind = 1 AND length(hit) >= 20) OR kind = 2),
h AS (SELECT rid, kind, a, a + i AS x, w, lag(a + i) OVER (PARTITION BY rid, kind, a ORDER BY i) AS before FROM ({classes})),
e AS (SELECT rid, kind, min(x) AS a, max(x) + any_value(w) AS b FROM (SELECT *, sum(CASE WHEN before IS NULL OR x > before + w THEN 1 ELSE 0 END) OVER (PARTITION BY rid, kind, a ORDER BY x) AS part FROM h)
      GROUP BY rid, kind, a, part),
z AS (SELECT *, ({kinds})[kind + 1] AS name FROM (SELECT * FROM b UNION ALL
      SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.rid = e.rid AND b.a <= e.a AND e.b <= b.b)))
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256({shown(f"FILTER (kind < {base})")}) AS base_sha256, {shown("")} AS spans FROM d LEFT JOIN z USING (rid) GROUP BY rid, doc_id"""


ORACLES = {
    "op11_conversation_repair": _REPAIR_ORACLE,
    "op12_secret_scan": _secret_oracle(),
    "op2_substring_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
h AS (SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS key
      FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
r AS (SELECT rid, i FROM h JOIN (SELECT key FROM h GROUP BY key HAVING count(*) > 1) USING (key)),
g AS (SELECT rid, list(DISTINCT p) AS gone FROM (SELECT rid, unnest(range(i, i + 35)) AS p FROM r) GROUP BY rid),
k AS (SELECT d.rid, d.doc_id, len(d.w) AS n, coalesce(len(gone), 0) AS m,
             list_filter(list_transform(d.w, lambda x, i: CASE WHEN gone IS NULL OR NOT list_contains(gone, i) THEN x END), lambda x: x IS NOT NULL) AS kept
      FROM d LEFT JOIN g USING (rid))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(m AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k""",
    "op5_embedding_dedup": """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT rid, vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS len FROM v
      WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.rid AS x, b.rid AS y FROM n a JOIN n b ON a.rid <> b.rid AND len(a.e) = len(b.e)
      WHERE a.len > 0 AND b.len > 0 AND list_dot_product(a.e, b.e) / (a.len * b.len) >= 0.9),
c AS (WITH RECURSIVE t(x, y) AS (SELECT x, y FROM l UNION SELECT t.x, l.y FROM t JOIN l ON t.y = l.x) SELECT x, min(v.vec_id) AS m FROM t JOIN v ON v.rid = t.y GROUP BY x)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.x = v.rid) AS n_links, least(v.vec_id, coalesce(c.m, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(c.m, v.vec_id)) AS kept
FROM v LEFT JOIN c ON c.x = v.rid""",
    "op10_ngram_join": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (SELECT rid, array_to_string(w, ' ') AS g FROM d WHERE len(w) BETWEEN 1 AND 3
      UNION SELECT rid, array_to_string(w[i:i + 3], ' ') FROM (SELECT rid, w, unnest(range(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 4)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
o AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.rid <> b.rid GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM o JOIN n nx ON nx.rid = x JOIN n ny ON ny.rid = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
t(x, y) AS (SELECT x, y FROM l UNION SELECT t.x, l.y FROM t JOIN l ON t.y = l.x),
m AS (SELECT t.x, min(d.doc_id) AS m FROM t JOIN d ON d.rid = t.y GROUP BY t.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.m, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.rid = d.rid LEFT JOIN m ON m.x = d.rid""",
    "op4_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS4.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS4.format("coalesce(text, '')")} AS w FROM benchmark),
p AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS key
      FROM (SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT DISTINCT k FROM p),
h AS (SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS key
      FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, s WHERE len(w) >= k)),
m AS (SELECT h.rid, h.i, p.k, p.item FROM h JOIN p ON h.key = p.key AND h.k = p.k),
hit AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS pos FROM m) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS its FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(its, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)""",
    "op6_url_filter": f"""
WITH rules(rh, rp, rv) AS (VALUES {_RULE_VALUES}),
u AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
f AS (SELECT host, path, max_by(rh || rp, length(rh || rp)) AS rule, max_by(rv, length(rh || rp)) AS rv
      FROM (SELECT DISTINCT host, path FROM h), rules
      WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
SELECT h.page_id, h.host, h.path, f.rule, coalesce(f.rv, 'allow') AS verdict
FROM h LEFT JOIN f ON h.host = f.host AND h.path = f.path""",
}
