"""Incremental landing of calibrated event files.

Instead of a batch re-run that skips the runs already done, the file source remembers in its checkpoint which files it has landed, so a re-run
reads the new ones only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope.functions import names
from duoscope.sources.events import not_blank, parse_calib, with_seq
from duoscope.sources.shared import PACKED


def land_calib(spark: SparkSession, path: str, table: str, checkpoint: str) -> None:
    """Lands all files below ``path`` that are not landed yet, then returns.

    Rows keep their place in their file. A repeated batch (after a failure)
    replaces its own folder, so every file lands exactly once.
    """
    lines = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            "value",
            names.source_name(F.col("_metadata.file_path")).alias("name"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split_start"),
        )
    )

    def land(batch: DataFrame, number: int) -> None:
        rows = batch.filter(not_blank()).withColumn("split_row", F.monotonically_increasing_id())
        parse_calib(rows).write.mode("overwrite").options(**PACKED).parquet(f"{table}/batch={number}")

    query = (
        lines.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landed_events(spark: SparkSession, table: str) -> DataFrame:
    """All landed rows with ``seq``, their position in the stacked files of their run."""
    rows = spark.read.option("basePath", table).parquet(f"{table}/batch=*").drop("batch")
    return with_seq(rows, stored=True)
