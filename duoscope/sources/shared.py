"""Tables written to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BinaryType

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path below the cluster's checkpoint folder.

    Where the setting is missing, a local master gets a temporary folder (its
    tasks run on this machine); any other master is an error.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set(CHECKPOINT_CONF, root)
    return f"{root.rstrip('/')}/duoscope/{label}-{uuid.uuid4().hex}"


LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
# Folders are listed in so many tasks for each core.
LISTING_TASKS = 4


@contextmanager
def many_folders(spark: SparkSession) -> Iterator[None]:
    """Tables opened here have their folders listed by a few tasks, instead of one task for each folder.

    The setting is restored afterwards; a smaller one stays.
    """
    before = spark.conf.get(LISTING_CONF)
    spark.conf.set(LISTING_CONF, min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(LISTING_CONF, before)


# Files as large as their rows: Spark takes the size of a table for that of its files.
PLAIN = {"compression": "none", "parquet.enable.dictionary": "false"}
# Whole texts, packed cells and whole scans with their features: stored as small as they get.
PACKED = {"compression": "zstd"}


def written(df: DataFrame, label: str, wide: dict[str, str] | None = None) -> DataFrame:
    """Writes ``df`` once and reads it back: cuts the lineage, survives lost executors.

    Positions and keys are stored plainly. Compressed, ten million of them are smaller than
    ``spark.sql.autoBroadcastJoinThreshold``, and the driver would collect them for a broadcast.
    Tables with arrays are large in any case, and so are those with binary cells. ``wide`` are the
    options of the writer for a table with arrays.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    kinds = {type(field.dataType) for field in df.schema}
    options = PACKED if BinaryType in kinds else (wide or {}) if ArrayType in kinds else PLAIN
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def listed(df: DataFrame, label: str) -> DataFrame:
    """Writes a table of one row per run, file or batch before it meets the events.

    Spark then plans that join with the table's real size: below
    ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast and the events stay
    where they are; above it both sides are shuffled.
    """
    return written(df, label)
