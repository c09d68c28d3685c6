"""Norm tables, predictions and energies as text or Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duoscope.functions import names
from duoscope.sources.events import require_nonempty
from duoscope.sources.shared import written

# Columns of prediction files, output formats.
DATA_PREDICTION = ("DL", "eventlinking1", "eventlinking2", "eventlinking3")
MC_PREDICTION = ("MCTruth", "DL")
PREDICTION_NAMES = {
    "DL": "dl",
    "MCTruth": "mc_truth",
    "eventlinking1": "nanotime",
    "eventlinking2": "time2",
    "eventlinking3": "id",
}
NUMBER_FORMAT = "%.8f"
NORM_SCHEMA = "pos int, mean double, std double"


def write_norm(norm: DataFrame, path: str, fmt: str = "csv") -> DataFrame:
    """Replaces the norm table; ``pos`` is kept, so row order does not matter."""
    ordered = norm.select("pos", "mean", "std")
    if fmt == "csv":
        ordered.write.mode("overwrite").option("sep", " ").csv(path)
    else:
        ordered.write.mode("overwrite").parquet(path)
    return read_norm(norm.sparkSession, path, fmt)


def read_norm(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A norm written by :func:`write_norm`."""
    if fmt == "csv":
        return spark.read.schema(NORM_SCHEMA).option("sep", " ").csv(path)
    return spark.read.schema(NORM_SCHEMA).parquet(path)


def write_plain_norm(norm: DataFrame, path: str) -> DataFrame:
    """The exchange layout: one headerless file, mean and std, where the line number is the position.

    A norm has one line per feature and does not grow with the events, so one task
    writes it.
    """
    lines = norm.select("pos", F.concat_ws(" ", F.col("mean").cast("string"), F.col("std").cast("string")).alias("value"))
    lines.repartitionByRange(1, "pos").sortWithinPartitions("pos").select("value").write.mode(
        "overwrite"
    ).text(path)
    return read_plain_norm(norm.sparkSession, path)


def read_plain_norm(spark: SparkSession, path: str) -> DataFrame:
    """A headerless two-column norm file, where the line number is the position.

    The file has one line per feature, so a single small task numbers them.
    """
    lines = require_nonempty(spark, path, "text").select(
        F.split(F.trim("value"), r"\s+").alias("_v"),
        F.monotonically_increasing_id().alias("_row"),
        F.col("_metadata.file_block_start").alias("_start"),
    )
    position = F.row_number().over(Window.orderBy("_start", "_row")) - 1
    return lines.select(
        position.cast("int").alias("pos"),
        F.get("_v", 0).try_cast("double").alias("mean"),
        F.get("_v", 1).try_cast("double").alias("std"),
    )


def read_predictions(spark: SparkSession, path: str, mode: str = "data") -> DataFrame:
    """Space-separated model outputs; ``mode`` ("data" or "mc") names the columns."""
    if mode not in ("data", "mc"):
        raise ValueError(f"mode must be data or mc, not {mode}")
    columns = DATA_PREDICTION if mode == "data" else MC_PREDICTION
    schema = ", ".join(f"{c} double" for c in columns)
    rows = require_nonempty(spark, path, "csv", schema, recursiveFileLookup="true", sep=" ")
    name = names.source_name(F.col("_metadata.file_path"))
    kept = [
        (F.col(c).try_cast("long") if c == "eventlinking3" else F.col(c)).alias(PREDICTION_NAMES[c])
        for c in columns
    ]
    return rows.select(
        name.alias("name"),
        *kept,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("split_row"),
    )


def fixed_decimals(x) -> Column:
    """Text with 8 decimals; infinities as ``inf``, NaN and null as empty text."""
    inf = float("inf")
    return (
        F.when(x.isNull() | F.isnan(x), "")
        .when(x == inf, "inf")
        .when(x == -inf, "-inf")
        .otherwise(F.format_string(NUMBER_FORMAT, x))
    )


def impute_value(x) -> Column:
    """Infinite energies become 0 in the imputation output."""
    return F.when(F.abs(x) == float("inf"), 0.0).otherwise(x)


def write_energies(
    energies: DataFrame,
    path: str,
    outputs=("impute", "validate"),
    order: str | None = "seq",
    stored: bool = False,
    by: str = "run",
) -> dict[str, str]:
    """Writes the requested energy tables, one folder per run, and returns their paths.

    With ``by="name"`` there is a folder ``file=…`` for each prediction file instead, called as
    the naming rule for energies has it (``names.energy_name``).

    ``impute`` has one number per line, a missing one as ``""`` so that every event
    keeps its line; ``validate`` (simulation only) has
    true and estimated energy with a header. Rows keep their order inside a run.
    Runs that are written again are replaced, all others stay. The rows are worked out
    once and both outputs written from the stored result; ``stored`` says that they are a
    table on disk already.
    """
    unknown = set(outputs) - {"impute", "validate"}
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    if by not in ("run", "name"):
        raise ValueError(f"by must be run or name, not {by}")
    paths = {}
    columns = [c for c in (by, order, "dl", "mc_truth") if c in energies.columns]
    rows = energies.select(*columns)
    if not stored:
        rows = written(rows, "energies")
    if order in energies.columns:
        # A given number of ranges: folders take the time, and by their size these narrow rows are few tasks.
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartitionByRange(tasks, by, order).sortWithinPartitions(by, order)

    def place(suffix: str) -> Column:
        return F.col("run") if by == "run" else names.energy_name(F.col("name"), suffix).alias("file")

    def sink(out: DataFrame):
        return out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(out.columns[0])

    if "impute" in outputs:
        paths["impute"] = f"{path}/impute"
        text = fixed_decimals(impute_value(F.col("dl")))
        line = F.when(text == "", '""').otherwise(text).alias("value")
        sink(rows.select(place(names.IMPUTE_SUFFIX), line)).text(paths["impute"])
    if "validate" in outputs and "mc_truth" in energies.columns:
        paths["validate"] = f"{path}/validate"
        lines = rows.select(
            place(names.VALIDATE_SUFFIX),
            fixed_decimals(F.col("mc_truth")).alias("MCTruth"),
            fixed_decimals(F.col("dl")).alias("DL"),
        )
        sink(lines).option("emptyValue", "").option("header", "true").csv(paths["validate"])
    return paths
