"""Operators on lists of files and runs, and consistency checks between them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope.functions import names
from duoscope.operators.ordering import number_list
from duoscope.sources.shared import listed

# Size of a stacked output file, share of training runs.
MAX_BYTES = 2_500_000_000
TRAIN_SHARE = 0.6
#: Batch of files that a list of batches does not have.
UNLISTED = -1


def unpaired_files(left: DataFrame, right: DataFrame, old: str = "_M1_", new: str = "_M2_") -> DataFrame:
    """Names that only one list has once ``old`` is replaced by ``new`` in both."""
    key = F.replace(names.base_name(F.col("name")), F.lit(old), F.lit(new)).alias("key")
    a = left.select(key).distinct().withColumn("in_left", F.lit(True))
    b = right.select(key).distinct().withColumn("in_right", F.lit(True))
    return (
        a.join(b, "key", "full_outer")
        .na.fill(False, ["in_left", "in_right"])
        .filter(~(F.col("in_left") & F.col("in_right")))
    )


def missing_partner(files: DataFrame) -> DataFrame:
    """Names that should exist because the other telescope has the file."""
    m1, m2 = names.split_telescopes(files.select("name"))
    from_m2 = m2.select(F.replace("name", F.lit("_M2_"), F.lit("_M1_")).alias("name"))
    from_m1 = m1.select(F.replace("name", F.lit("_M1_"), F.lit("_M2_")).alias("name"))
    lost_m1 = from_m2.subtract(m1).withColumn("missing_from", F.lit("M1"))
    lost_m2 = from_m1.subtract(m2).withColumn("missing_from", F.lit("M2"))
    return lost_m1.unionByName(lost_m2)


def missing_runs(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Runs that are in exactly one of the lists; none if the lists are equal.

    ``side`` is ``missing`` (wanted but not present) or ``extra``; a superset check
    looks at ``missing`` alone.
    """
    a, b = wanted.select("run"), present.select("run")
    lost = a.subtract(b).withColumn("side", F.lit("missing"))
    extra = b.subtract(a).withColumn("side", F.lit("extra"))
    return lost.unionByName(extra)


def count_mismatch(status: DataFrame) -> DataFrame:
    """Kept counts per run: equal for both telescopes, within 1 of the stereo rows."""

    def of(tel: str, column: str):
        return F.max(F.when(F.col("tel") == tel, F.col(column)))

    wide = status.groupBy("run").agg(
        of("M1", "n_kept").alias("n_1"),
        of("M2", "n_kept").alias("n_2"),
        F.max("n_ref").alias("n_ref"),
    )
    near = (F.abs(F.col("n_1") - F.col("n_ref")) <= 1) & (F.abs(F.col("n_2") - F.col("n_ref")) <= 1)
    return wide.withColumn("ok", (F.col("n_1") == F.col("n_2")) & near)


def batch_files(files: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Groups files, in name order, into ``total_bytes // max_bytes`` contiguous batches.

    Sizes differ by at most one file, larger batches first; fewer bytes than
    ``max_bytes`` give one batch.
    """
    totals = files.agg(
        F.count("*").alias("files"),
        F.greatest(F.floor(F.sum("bytes") / F.lit(float(max_bytes))), F.lit(1)).alias("batches"),
    )
    total = totals.select(F.struct("files", "batches")).scalar()
    n_files, n_batches = total["files"], total["batches"]
    numbered = number_list(files, "name", "_index").select(
        "*",
        F.floor(n_files / n_batches).alias("_base"),
        (n_files % n_batches).alias("_longer"),
    )
    size, longer, index = F.col("_base"), F.col("_longer"), F.col("_index")
    edge = longer * (size + 1)
    early = F.floor(index / (size + 1))
    late = longer + F.floor((index - edge) / F.greatest(size, F.lit(1)))
    return numbered.select(
        *files.columns, F.when(index < edge, early).otherwise(late).cast("long").alias("batch")
    )


def union_batches(events: DataFrame, batched: DataFrame) -> DataFrame:
    """Events with the batch of their file; write them ``partitionBy("batch")``.

    Events of files that are in no batch stay, as batch ``UNLISTED``.
    """
    batches = listed(batched.select("name", "batch"), "batches")
    return events.join(batches, "name", "left").na.fill(UNLISTED, ["batch"])


def unlisted_files(events: DataFrame, batched: DataFrame) -> DataFrame:
    """name, n_rows of the files with events that are in no batch."""
    rows = events.groupBy("name").agg(F.count("*").alias("n_rows"))
    return rows.join(batched.select("name"), "name", "left_anti")


def write_batches(stacked: DataFrame, path: str, max_records: int = 0) -> None:
    """One folder per batch; ``max_records`` bounds the rows per file.

    The rows of a batch are brought together first (``rebalance``, which splits large batches), instead
    of one small file per task and batch.
    """
    stacked.hint("rebalance", "batch").write.mode("overwrite").option("maxRecordsPerFile", max_records).partitionBy(
        "batch"
    ).parquet(path)


def size_conserved(before: DataFrame, after: DataFrame, by: str = "name") -> DataFrame:
    """Rows times features per file (or ``by``), of the input and of what was stacked from it."""

    def cells(frame: DataFrame, name: str) -> DataFrame:
        return frame.groupBy(by).agg(F.sum(F.size("pix").cast("long")).alias(name))

    both = cells(before, "cells_before").join(cells(after, "cells_after"), by, "full_outer")
    same = F.col("cells_before").eqNullSafe(F.col("cells_after"))
    return both.na.fill(0, ["cells_before", "cells_after"]).withColumn("ok", same)


def run_sets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Intersection, differences and symmetric difference of two run lists."""
    a, b = left.select("run"), right.select("run")
    only_a, only_b = a.subtract(b), b.subtract(a)
    parts = {
        "both": a.intersect(b),
        "left_only": only_a,
        "right_only": only_b,
        "either": only_a.unionByName(only_b),
    }
    tagged = [frame.withColumn("part", F.lit(name)) for name, frame in parts.items()]
    return reduce(DataFrame.unionByName, tagged)


def train_test_split_runs(runs: DataFrame, share: float = TRAIN_SHARE) -> DataFrame:
    """Side of every run: in run order the first ``int(n * share) - 1`` are for training.

    Joined to the events by run, both telescopes of a run land on the same side.
    """
    if not 0 <= share <= 1:
        raise ValueError("share must lie between 0 and 1")
    numbered = number_list(runs.select("run").distinct(), "run", "_index")
    n = numbered.agg(F.count("*")).scalar()
    n_train = (n * F.lit(float(share))).cast("long") - 1
    return numbered.select(
        "run", F.when(F.col("_index") < n_train, "train").otherwise("test").alias("side")
    )


def with_side(events: DataFrame, sides: DataFrame) -> DataFrame:
    return events.join(listed(sides, "sides"), "run")
