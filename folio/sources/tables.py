"""Readers. Every table carries an explicit order column, as Spark rows have none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sections(documents: DataFrame) -> DataFrame:
    """Documents as sections: book = source, position = order of the id within the book."""
    return documents.select(F.col("source").alias("book"), F.col("doc_id").alias("section_id"), "lang", F.coalesce("text", F.lit("")).alias("content"))


def trade(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """Lines as relation votes between a customer's and a supplier's nation; the volume is the order's year."""
    return (
        lineitem.join(orders, F.expr("l_orderkey = o_orderkey"))
        .join(customer.select("c_custkey", "c_nationkey"), F.expr("o_custkey = c_custkey"))
        .join(supplier.select("s_suppkey", "s_nationkey"), F.expr("l_suppkey = s_suppkey"))
        .select(
            F.col("c_nationkey").alias("src"),
            F.col("s_nationkey").alias("dst"),
            F.year("o_orderdate").alias("volume"),
            F.col("l_returnflag").alias("type"),
            F.col("l_orderkey").alias("chunk"),
            F.col("l_linenumber").alias("seq"),
        )
    )


def read_json_artifact(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An artifact with a declared schema; rows that don't parse stop the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_json_artifact(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def resume(candidates: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a scan still has to fetch: candidates whose key isn't there yet."""
    return candidates.join(done.select(key), key, "left_anti")


def first_success(log: DataFrame, stage: str) -> DataFrame:
    """Of log lines (line_no, event, stage, status, output) the first completed output of a stage."""
    hit = log.where((F.col("event") == "stage_complete") & (F.col("stage") == stage) & (F.col("status") == "success"))
    return hit.agg(F.min_by("output", "line_no").alias("output"))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share. Without one a local session uses its warehouse; a cluster is an error."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return sc.getCheckpointDir()
