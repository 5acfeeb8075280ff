"""A registry that grows volume by volume, as a stream whose batches are written once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.sources.tables import shared_folder

SCHEMA = "entity long, volume string, mentions long, first_seen timestamp, run long, batch long"


def latest(registry: DataFrame) -> DataFrame:
    """Of each volume the rows of its last run: a volume that is read again replaces itself, however many batches it came in."""
    last = registry.groupBy("volume").agg(F.max("run").alias("run"))
    return registry.join(last, ["volume", "run"], "left_semi")


def totals(registry: DataFrame) -> DataFrame:
    """Mentions, volumes and first sight of each entity."""
    return latest(registry).groupBy("entity").agg(F.sum("mentions").alias("mentions"), F.count_distinct("volume").alias("volumes"), F.min("first_seen").alias("first_seen"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The registry as stored: partitions run=, batch= of its folder."""
    return spark.read.schema(SCHEMA).parquet(f"{folder}/rows")


def run(spark: SparkSession, source: DataFrame, folder: str | None = None, number: int = 1) -> DataFrame:
    """Drain ``source`` (a stream of entity, volume, ts) as run ``number``; what it wrote is read back from storage.

    A batch adds its own partition and rewrites nothing; a retry overwrites the partition of its number, so that it counts once. All
    state lies in ``folder``: a restart goes on where the log ends, and needs nothing of the process before.
    """
    folder = folder or f"{shared_folder(spark)}/registry-{spark.sparkContext.applicationId}-{id(source)}"

    def step(batch: DataFrame, n: int) -> None:
        own = batch.groupBy("entity", "volume").agg(F.count("*").alias("mentions"), F.min("ts").alias("first_seen"))
        own.write.mode("overwrite").parquet(f"{folder}/rows/run={number}/batch={n}")

    query = source.writeStream.foreachBatch(step).option("checkpointLocation", f"{folder}/log-{number}").trigger(availableNow=True).start()
    query.awaitTermination()
    return read(spark, folder)
