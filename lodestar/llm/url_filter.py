"""URL filter: a blocked Bloom filter in front of an exact hash join.

Every url gives a few *keys*, ``host suffix + path prefix``, one for each
suffix of its host and each path length that a rule can have.  A rule fits
the url exactly if the rule's ``host + path`` is one of the keys.  The listed
keys are first put into a blocked Bloom filter: a key's hash names one block
of eight 32-bit words, and one bit in each word.  A key whose bits are not all
set is not listed; the others go on to a hash join with the list itself, which
removes the filter's false positives.  Only DataFrame functions are used.

Listed urls without a rule path work the same: ``listed`` holds canonical
urls (``host + path``) to block as a whole, which a url meets with all of its
own ``host + path``; rules win over them.

Sizes: the filter has one row per used block (at most one per listed key).
It and the list are broadcast by Spark only where their measured size is
under the session's broadcast threshold; beyond it the same joins shuffle,
and adaptive execution splits a hot key.  A url text is judged once however
many pages have it.

Defined results: a null url, or one without ``://``, has an empty host and
path and no rule; ports and user names stay part of the host; of two rules of
one length the one with the longer host wins, and ``block`` wins over
``allow`` for the same key; null rules are ignored; without a rule the verdict
is ``block`` for a listed canonical url and else ``allow``.  Empty tables,
repeated rows and further columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8            # 32-bit words in a block, one bit set in each
KEYS_PER_BLOCK = 16  # 16 bits a key: about 1 false positive in 1,000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> Column:
    """For each word of the block a mask with one bit: five bits of a second hash, made anew for each word."""
    return F.array(*[F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(F.lit(i), key), F.lit(32)).cast("int"))
                     for i in range(WORDS)])


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter as rows ``(block, words)`` for the column ``key`` of ``keys``."""
    parts = keys.select(_block(F.col("key"), blocks).alias("block"), _bits(F.col("key")).alias("bits"))
    return parts.groupBy("block").agg(F.array(*[F.bit_or(F.col("bits")[i]) for i in range(WORDS)]).alias("words"))


def judge_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame | None = None, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names in ``pages`` are replaced.

    ``rules``: ``host``, ``path`` and ``verdict`` (``allow`` or ``block``);
    ``listed``: canonical urls in its first column, without scheme.
    """
    rules = rules.where("host is not null and path is not null and verdict in ('allow', 'block')")
    rules = rules.groupBy(F.concat("host", "path").alias("key"), F.col("host").alias("rule_host")).agg(F.max("verdict").alias("rule_verdict"))
    # Few values, whatever the number of rules: how many labels a rule's host has at most, and the lengths of their paths.
    shape = rules.agg(F.max(F.size(F.split("rule_host", r"\."))), F.collect_set(F.length("key") - F.length("rule_host")),
                      F.count("*")).first()
    labels, lengths, n_keys = shape[0] or 1, sorted(shape[1]), shape[2]
    entries = rules.select("key", "rule_host", "rule_verdict")
    if listed is not None:
        whole = listed.select(F.col(listed.columns[0]).alias("key")).where("key is not null").distinct()
        n_keys += whole.count()
        entries = entries.unionByName(whole.select("key", F.lit(None).cast("string").alias("rule_host"),
                                                   F.lit(None).cast("string").alias("rule_verdict")))
    blocks = max(1, -(-n_keys // KEYS_PER_BLOCK))

    pages = pages.drop("host", "path", "rule", "verdict") if url not in ("host", "path", "rule", "verdict") else pages
    asked = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    urls = asked.select("host", "path").distinct()
    name = F.split("host", r"\.")
    from_label = F.sequence(F.greatest(F.lit(1), F.size(name) - F.lit(labels - 1)), F.size(name))
    suffixes = F.transform(from_label, lambda i: F.array_join(F.slice(name, i, F.size(name)), "."))
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>")
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(
        F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.struct(s.alias("s"), F.concat(s, p).alias("key")))))
    own = F.array(F.struct(F.lit(None).cast("string").alias("s"), F.concat("host", "path").alias("key")))
    tries = urls.select("host", "path", F.explode(F.concat(keys, own) if listed is not None else keys).alias("k")) \
        .select("host", "path", F.col("k.s").alias("s"), F.col("k.key").alias("key")).where("host <> ''")
    # The filter: keys whose block has all of their bits.
    filtered = tries.withColumn("block", _block(F.col("key"), blocks)).join(bloom_blocks(entries, blocks), "block")
    bits = _bits(F.col("key"))
    possible = filtered.where(F.forall(F.arrays_zip(F.col("words").alias("w"), bits.alias("b")),
                                       lambda x: x["w"].bitwiseAND(x["b"]) == x["b"])).drop("words", "block")
    # The exact join; the host must be the rule's own, not only the same joined text.
    e = entries.withColumnRenamed("key", "e_key")
    hits = possible.join(e, (F.col("key") == F.col("e_key")) & F.col("s").eqNullSafe(F.col("rule_host")))
    best = F.max(F.struct(F.when(F.col("rule_host").isNotNull(), F.length("key")).otherwise(-1).alias("n"),
                          F.length("rule_host").alias("h"), F.col("rule_verdict").alias("v"), F.col("key").alias("key")))
    judged = hits.groupBy("host", "path").agg(best.alias("__best"))
    out = asked.join(judged, ["host", "path"], "left")
    fits = F.col("__best.n") >= 0
    return out.select(*[F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path")], "host", "path",
                      F.when(fits, F.col("__best.key")).alias("rule"),
                      F.when(fits, F.col("__best.v")).when(F.col("__best").isNotNull(), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))
