"""The corpus pipeline: quality rules, toxicity, near-duplicates, repeated passages, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir), and what it returns is written as
Parquet in the shared checkpoint folder and read again as the next one's ``docs``. All but the last return the columns of
``documents``. A row goes through the filters as one struct, so repeated ids with different texts are judged apart and columns of any
name come back untouched, but for ``text`` and ``n_chars`` after the fourth stage, and names that begin with two underscores,
which are the stages' own. Null and empty texts fail the quality rules; an empty table gives an empty result; a null id is a document
like any other. Ties between near copies go to the smallest id, then to the smallest hash of the row; repeated rows are near copies of each
other. Very long texts are read whole by every stage. The folder of the stages is left to the owner of the checkpoint folder, as the
result is read from it.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import ngram_join, packing, quality, substring_dedup, toxicity
from folio.llm.common import checkpoint, checkpoint_folder, hot_join, table


def _rows(docs: DataFrame) -> DataFrame:
    """Each row as one struct that goes through an operator as its id, beside what the operator reads."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), "text", "lang")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their language's perplexity bands reject go."""
    return quality.quality_rules(_rows(docs), id_col="__row").where("kept").select("__row.*")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; the model is learned from the labelled documents that are left."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(_rows(docs), model, id_col="__row").where("predicted = 0").select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles at 80 per cent, the one with the smallest id stays, once.

    Documents without words link with nothing and stay. Different rows under one id are vertices of their own, named by
    a hash; null ids too. Of those the one with the smallest id, then name, stays.
    """
    whole = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    named = docs.withColumn("__hash", whole)
    several = checkpoint(named.groupBy("doc_id").agg(F.count("*").alias("__n"), F.min("__hash").alias("__lo"), F.max("__hash").alias("__hi")).where("__lo < __hi").select("doc_id", "__n"))
    named = hot_join(named, several, ["doc_id"], "__n", "__hash", "left")
    named = named.withColumn("__vertex", F.expr("if(doc_id is null or __n is not null, __hash, doc_id)")).drop("__hash", "__n")
    groups = ngram_join.ngram_jaccard_join(named, id_col="__vertex", n=5, percent=80)
    groups = groups.join(named.select("__vertex", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("__id")).distinct(), "__vertex").distinct()
    best = groups.groupBy("component_id").agg(F.min(F.struct("__id", "__vertex")).alias("__best"))
    kept = best.select(F.col("__best.__vertex").alias("__vertex"))
    return named.join(kept, "__vertex", "left_semi").dropDuplicates(["__vertex"]).select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in a 20-word window that starts earlier in the corpus go; n_chars follows the text."""
    out = substring_dedup.substring_dedup(docs, result="__dedup")
    changed = out.withColumn("text", F.col("__dedup.kept_text")).withColumn("n_chars", F.length("text").cast("long"))
    return changed.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of each document that is left: its bin, its place there and the bin's length."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"

    def step(docs: DataFrame, at: tuple) -> DataFrame:
        stage(spark, docs, sf_dir, at, folder)
        return spark.read.parquet(f"{folder}/{at[0]}")

    return reduce(step, STAGES, table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, at: tuple, folder: str) -> None:
    name, function = at
    function(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")


ORACLE_SQL = None  # perplexity bands, a learned lexicon and best fit have no SQL form; tests/llm/test_pipeline.py compares each stage with a plain version
