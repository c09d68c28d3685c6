"""Positions, occurrences and running values inside long ordered groups.

A run may hold a large share of all rows, and so may one key. None of these
functions sorts a whole group in one task: rows are ordered inside *blocks* of
bounded size, and only one narrow row per block takes part in the step that
runs over the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duoscope.sources.shared import listed, written

BLOCK_ROWS = 1_000_000


def block_of(seq, block_rows: int = BLOCK_ROWS) -> Column:
    return F.floor(F.col(seq) / F.lit(block_rows)).cast("long")


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    block: Sequence[Column],
    order: Sequence[str],
    out: str = "seq",
) -> DataFrame:
    """Adds the 0-based position of each row in its group.

    ``block`` is one or more expressions that do not decrease along ``order``
    and cut a group into pieces of bounded size (an hour, a file split, a range
    of sequence numbers). Rows are sorted per piece; the pieces' row counts,
    combined before their shuffle, give the offset of each piece.
    """
    blocks = [f"_block{i}" for i in range(len(block))]
    tagged = df.select("*", *[expr.alias(name) for expr, name in zip(block, blocks)])
    pieces = tagged.groupBy(*group, *blocks).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*group).orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        pieces.withColumn("_offset", F.sum("_rows").over(before))
        .filter(F.col("_offset") > 0)
        .drop("_rows")
    )
    local = Window.partitionBy(*group, *blocks).orderBy(*order)
    placed = tagged.withColumn("_local", F.row_number().over(local) - 1)
    return null_safe_join(placed, offsets, [*group, *blocks], "left").select(
        *df.columns,
        (F.col("_local") + F.coalesce("_offset", F.lit(0))).cast("long").alias(out),
    )


def number_list(df: DataFrame, order: str, out: str) -> DataFrame:
    """Adds the 0-based position of each row in a whole list, such as all files by name.

    Rows are ordered inside ranges of names; the ranges are stored with the rows,
    as another evaluation could cut them elsewhere.
    """
    ranged = df.repartitionByRange(order).withColumn("_range", F.spark_partition_id())
    return number_rows(written(ranged, "list"), [], [F.col("_range")], [order], out).drop("_range")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null equals null; keeps the columns of ``left`` and the rest of ``right``."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    condition = None
    for c in on:
        same = left[c].eqNullSafe(renamed[f"_r_{c}"])
        condition = same if condition is None else condition & same
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_r_{c}" for c in on])


def with_occurrence(
    df: DataFrame,
    group: Sequence[str],
    keys: Sequence[str],
    seq: str,
    block_rows: int = BLOCK_ROWS,
    out: str = "occ",
) -> DataFrame:
    """Adds the 1-based count of earlier rows of the group with the same keys.

    Only groups longer than one block need offsets between blocks, so the counts
    per key and block are taken from those groups alone. They are listed first:
    without any, no other row is counted or shuffled for the offsets.
    """
    tagged = df.withColumn("_block", block_of(seq, block_rows))
    local = Window.partitionBy(*group, *keys, "_block").orderBy(seq)
    placed = tagged.withColumn("_local", F.row_number().over(local))
    long_groups = (
        tagged.groupBy(*group).agg(F.max("_block").alias("_last")).filter("_last > 0").select(*group)
    )
    long_groups = listed(long_groups, "long-groups")
    if long_groups.isEmpty():
        return placed.select(*df.columns, F.col("_local").cast("long").alias(out))
    pieces = (
        tagged.join(long_groups, list(group), "left_semi")
        .groupBy(*group, *keys, "_block")
        .agg(F.count("*").alias("_rows"))
    )
    before = (
        Window.partitionBy(*group, *keys)
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        pieces.withColumn("_offset", F.sum("_rows").over(before))
        .filter(F.col("_offset") > 0)
        .drop("_rows")
    )
    return placed.join(offsets, [*group, *keys, "_block"], "left").select(
        *df.columns,
        (F.col("_local") + F.coalesce("_offset", F.lit(0))).cast("long").alias(out),
    )


def running_max(
    df: DataFrame,
    group: Sequence[str],
    seq: str,
    value: Column,
    out: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Adds the largest ``value`` from the start of the group up to each row."""
    tagged = df.withColumn("_block", block_of(seq, block_rows)).withColumn("_value", value)
    pieces = tagged.groupBy(*group, "_block").agg(F.max("_value").alias("_top"))
    before = (
        Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        pieces.withColumn("_carry", F.max("_top").over(before))
        .filter(F.col("_carry").isNotNull())
        .drop("_top")
    )
    local = (
        Window.partitionBy(*group, "_block")
        .orderBy(seq)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = tagged.withColumn("_value", F.max("_value").over(local))
    return placed.join(carried, [*group, "_block"], "left").select(
        *df.columns, F.greatest("_value", "_carry").alias(out)
    )
