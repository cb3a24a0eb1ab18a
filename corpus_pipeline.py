"""A pipeline over ``documents``: from raw texts to packed sequences.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and returns
a DataFrame, which ``run`` writes as Parquet and reads again as the next one's
``docs``.  All but the last return the columns of ``documents``:

* ``quality``: documents that the classifier rejects go;
* ``near_duplicates``: one document of each group of near copies stays (five words, similarity 0.8);
* ``substring_dedup``: words in passages of 50 words or more that stand elsewhere too go
  from the text, whose other words are then joined by one space, and ``n_chars`` follows;
* ``decontaminate``: documents with a benchmark passage go;
* ``packing``: the pieces of sequences of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import catalog, decontaminate, ngram_join, packing, quality, substring_dedup
from lodestar.llm.components import stored
from lodestar.sources.tables import table

PASSAGE_WORDS = 50
NGRAM, SIMILARITY = 5, 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"), training=catalog.remainder(5) != 0)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    return quality.score_documents(rows, model, keep=["row"]).where(F.col("score") >= catalog.PASS_SCORE).select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, NGRAM, SIMILARITY)


def cut_repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    out = substring_dedup.remove_repeated(rows, PASSAGE_WORDS, keep=["row"])
    cut = F.col("n_removed") > 0
    new = {"text": F.when(cut, F.col("kept")).otherwise(F.col("row.text")),
           "n_chars": F.when(cut, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, catalog.tokenizer_file("word_bpe_49k.json"), end_id=1)


STAGES = [("quality", keep_good), ("near_duplicates", keep_one_of_each), ("substring_dedup", cut_repeated),
          ("decontaminate", drop_benchmark), ("packing", pack)]

#: SQL cannot express the classifier and the packing; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
