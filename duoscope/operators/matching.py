"""Ordered match of stereo keys against calibrated rows.

Walking the calibrated rows of a run in order, a row is kept when its keys equal
those of the next stereo row that is still open. A run is accepted when all its
stereo rows find their partner that way.

The walk is expressed with joins: the k-th stereo row with some keys is mapped
to the k-th calibrated row with the same keys. That map bounds every ordered
match from below, so where it is complete and increasing it *is* the walk. Only
runs whose map is complete but not increasing (repeated keys in mixed order) are
walked, on their keys alone.

The walk of one block depends on what came before only by the number of stereo rows
matched so far. The map read from the front bounds that number from above, the map read from
the back bounds it from below for any run that can succeed. So every block works out, for
all numbers between its bounds, the number it ends with; these functions are composed up
and down a tree of blocks, and all blocks are walked at once.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duoscope.operators.ordering import BLOCK_ROWS, block_of, running_max, with_occurrence
from duoscope.sources.shared import listed, shared_folder, written

# Key columns of observed and simulated events.
DATA_KEYS = ("nanotime", "time2", "id")
MC_KEYS = ("energy", "id", "zd", "az")

GROUP = ("run", "tel")
ACCEPTED = ("ok", "tail_dup")

# Blocks whose step functions are composed in one task; blocks of stereo rows that bounds may span.
FAN = 64
WIDE = 64


@dataclass(frozen=True)
class Match:
    """``kept``: run, tel, sseq, seq of the matched rows; ``status``: one row per run and telescope."""

    kept: DataFrame
    status: DataFrame


def without_nan_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys can be equal to something: no nulls, no NaN."""
    kept = df.dropna(subset=list(keys))
    types = dict(df.dtypes)
    for key in keys:
        if types[key] in ("double", "float"):
            kept = kept.filter(~F.isnan(key))
    return kept


def _occurrence_map(calib, stereo, keys, block_rows) -> DataFrame:
    """run, tel, sseq and the seq of the same occurrence of the same keys (or null)."""

    def numbered(rows, seq):
        return with_occurrence(rows, GROUP, keys, seq, block_rows)

    left, right = numbered(stereo, "sseq"), numbered(without_nan_keys(calib, keys), "seq")
    return left.join(right, [*GROUP, *keys, "occ"], "left").select(*GROUP, "sseq", "seq")


def _shape_of_map(mapping: DataFrame, block_rows: int) -> DataFrame:
    """Per run and telescope: length, gaps and order breaks of the map."""
    tagged = mapping.withColumn("_block", block_of("sseq", block_rows))
    local = Window.partitionBy(*GROUP, "_block").orderBy("sseq")
    missing = F.col("seq").isNull()
    pieces = (
        tagged.withColumn("_before", F.lag("seq").over(local))
        .groupBy(*GROUP, "_block")
        .agg(
            F.count("*").alias("_rows"),
            F.count_if(missing).alias("_missing"),
            F.max(F.when(missing, F.col("sseq"))).alias("_last_missing"),
            F.max(missing & (F.col("sseq") == 0)).alias("_first_missing"),
            F.count_if(F.col("seq") <= F.col("_before")).alias("_breaks"),
            F.min_by("seq", "sseq").alias("_first"),
            F.max_by("seq", F.when(~missing, F.col("sseq"))).alias("_last"),
        )
    )
    across = Window.partitionBy(*GROUP).orderBy("_block")
    return (
        pieces.withColumn("_edge", (F.col("_first") <= F.lag("_last").over(across)).cast("int"))
        .groupBy(*GROUP)
        .agg(
            F.sum("_rows").alias("n_ref"),
            F.sum("_missing").alias("n_missing"),
            F.max("_last_missing").alias("last_missing"),
            F.max("_first_missing").alias("first_missing"),
            (F.sum("_breaks") + F.coalesce(F.sum("_edge"), F.lit(0))).alias("n_breaks"),
            F.max("_last").alias("last_seq"),
        )
    )


def _equal_tails(stereo: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs whose last two stereo rows have the same keys."""
    ends = stereo.groupBy(*GROUP).agg(F.max("sseq").alias("_end"))
    tail = stereo.join(ends, list(GROUP)).filter(F.col("sseq") >= F.col("_end") - 1)
    same = F.lit(True)
    for key in keys:
        same = same & (F.min(key) == F.max(key))
    return (
        without_nan_keys(tail, keys)
        .groupBy(*GROUP)
        .agg(((F.count("*") == 2) & same).alias("tail_equal"))
    )


def _windows(calib, stereo, mapping, runs, keys, block_rows) -> DataFrame:
    """Stereo rows of ``runs`` with the first and last block of calibrated rows that may hold their partner.

    ``first`` and ``last`` do not decrease along a run. Where ``last`` is before ``first``, or
    there is none, the run cannot succeed.
    """
    # The last row may stay alone if it repeats the one before: it bounds nothing.
    ends = stereo.groupBy(*GROUP).agg(F.max("sseq").alias("_end")).join(runs, list(GROUP))
    rows = stereo.join(ends, list(GROUP))
    counted = rows.filter(~F.col("tail_equal") | (F.col("sseq") < F.col("_end")))
    ends_c = calib.groupBy(*GROUP).agg(F.max("seq").alias("_end"))
    back_c = calib.join(runs.select(*GROUP), list(GROUP), "left_semi").join(ends_c, list(GROUP))
    back_s = counted.select(*GROUP, (F.col("_end") - F.col("sseq")).alias("sseq"), *keys)
    back_c = back_c.select(*GROUP, (F.col("_end") - F.col("seq")).alias("seq"), *keys)
    late = running_max(
        _occurrence_map(back_c, back_s, keys, block_rows), GROUP, "sseq", F.col("seq"), "_back", block_rows
    )
    late = late.join(ends, list(GROUP)).join(ends_c.withColumnRenamed("_end", "_end_c"), list(GROUP))
    late = late.select(
        *GROUP,
        (F.col("_end") - F.col("sseq")).alias("sseq"),
        F.when(F.col("seq").isNotNull(), F.col("_end_c") - F.col("_back")).alias("_late"),
    )
    front = mapping.join(runs.select(*GROUP), list(GROUP), "left_semi")
    early = running_max(front, GROUP, "sseq", F.col("seq"), "_early", block_rows)
    bounds = early.join(late, [*GROUP, "sseq"], "left").join(ends.drop("_end"), list(GROUP))
    whole = ends.select(*GROUP, F.col("_end").alias("_last_row")).join(ends_c, list(GROUP))
    bounds = bounds.join(whole, list(GROUP))
    free = F.col("tail_equal") & (F.col("sseq") == F.col("_last_row"))
    return bounds.select(
        *GROUP,
        "sseq",
        block_of("_early", block_rows).alias("first"),
        F.when(free, block_of("_end", block_rows)).otherwise(block_of("_late", block_rows)).alias("last"),
    )


def stepper(keys: Sequence[str]):
    """Function for a cogroup of one block and one piece of its bounds: calibrated and stereo rows.

    It gives the open stereo row with which the block ends for each one, ``begin`` to ``end``,
    with which it may begin, as a step function: from ``froms[k]`` on the end is ``tos[k]``. It
    refers to nothing in this package, so workers need not import it.
    """
    keys = list(keys)

    def step(calib: pa.Table, stereo: pa.Table) -> pa.Table:
        calib, stereo = calib.sort_by("seq"), stereo.sort_by("sseq")
        owner = calib if calib.num_rows else stereo
        begin, end = owner.column("begin")[0].as_py(), owner.column("end")[0].as_py()
        wanted = list(zip(*[stereo.column(key).to_pylist() for key in keys]))
        base = stereo.column("sseq")[0].as_py() if stereo.num_rows else begin
        # Beginnings that reach the same open row go on as one: at[row] is the first of them.
        at = {p: p for p in range(begin - base, end - base + 1)}
        waiting: dict = {}
        for p in at:
            if p < len(wanted):
                waiting.setdefault(wanted[p], []).append(p)
        for row in zip(*[calib.column(key).to_pylist() for key in keys]):
            moved = waiting.pop(row, None)
            if not moved or None in row:
                continue
            for p in sorted(moved, reverse=True):
                group = at.pop(p)
                if p + 1 in at:
                    at[p + 1] = min(at[p + 1], group)
                    continue
                at[p + 1] = group
                if p + 1 < len(wanted):
                    waiting.setdefault(wanted[p + 1], []).append(p + 1)
        ends = sorted((base + group, base + p) for p, group in at.items())
        return pa.table(
            {
                "run": pa.array([owner.column("run")[0].as_py()], pa.string()),
                "tel": pa.array([owner.column("tel")[0].as_py()], pa.string()),
                "node": pa.array([owner.column("block")[0].as_py()], pa.int64()),
                "froms": pa.array([[first for first, _ in ends]], pa.list_(pa.int64())),
                "tos": pa.array([[last for _, last in ends]], pa.list_(pa.int64())),
            }
        )

    return step


def functions_of(table: pa.Table):
    """Numbers and step functions of the blocks of a group in their order; pieces of one block are joined."""
    nodes: dict = {}
    parts = zip(*[table.column(c).to_pylist() for c in ("node", "froms", "tos")])
    for node, froms, tos in sorted(parts):
        begin, end = nodes.setdefault(node, ([], []))
        begin.extend(froms)
        end.extend(tos)
    return nodes


def composer(functions_of, fan: int):
    """Function for up to ``fan`` neighbouring blocks: the step function that runs through all of them."""

    def compose(table: pa.Table) -> pa.Table:
        from bisect import bisect_right

        nodes = functions_of(table)
        parts = iter(nodes.values())
        ends = [list(pair) for pair in zip(*next(parts))]
        for begin, end in parts:
            for pair in ends:
                # Below the bounds of a block no run succeeds; -1 stays.
                pair[1] = end[bisect_right(begin, pair[1]) - 1] if pair[1] >= begin[0] else -1
            ends = [p for k, p in enumerate(ends) if not k or p[1] != ends[k - 1][1]]
        run, tel = (table.column(c)[0].as_py() for c in ("run", "tel"))
        return pa.table(
            {
                "run": pa.array([run], pa.string()),
                "tel": pa.array([tel], pa.string()),
                "node": pa.array([min(nodes) // fan], pa.int64()),
                "froms": pa.array([[p[0] for p in ends]], pa.list_(pa.int64())),
                "tos": pa.array([[p[1] for p in ends]], pa.list_(pa.int64())),
            }
        )

    return compose


def opener(functions_of):
    """Function for neighbouring blocks and the open row of the first: the open row of each."""

    def open_rows(table: pa.Table) -> pa.Table:
        from bisect import bisect_right

        nodes, here, found = functions_of(table), table.column("open")[0].as_py(), []
        for begin, end in nodes.values():
            here = here if here >= begin[0] else -1
            found.append(here)
            here = end[bisect_right(begin, here) - 1] if here >= 0 else -1
        n = len(found)
        run, tel = (table.column(c)[0].as_py() for c in ("run", "tel"))
        return pa.table(
            {
                "run": pa.array([run] * n, pa.string()),
                "tel": pa.array([tel] * n, pa.string()),
                "node": pa.array(list(nodes), pa.int64()),
                "open": pa.array(found, pa.int64()),
            }
        )

    return open_rows


def walker(keys: Sequence[str]):
    """Function for a cogroup of one run: (calibrated block, open stereo rows) to matched rows.

    It refers to nothing in this package, so workers need not import it.
    """
    keys = list(keys)

    def rows_of(table: pa.Table) -> list[tuple]:
        return list(zip(*[table.column(key).to_pylist() for key in keys]))

    def walk(calib: pa.Table, stereo: pa.Table) -> pa.Table:
        calib, stereo = calib.sort_by("seq"), stereo.sort_by("sseq")
        wanted = iter(zip(rows_of(stereo), stereo.column("sseq").to_pylist()))
        key, sseq = next(wanted, (None, None))
        found_sseq, found_seq = [], []
        for row, seq in zip(rows_of(calib), calib.column("seq").to_pylist()):
            if key is None:
                break
            if row == key and None not in row:
                found_sseq.append(sseq)
                found_seq.append(seq)
                key, sseq = next(wanted, (None, None))
        owner = calib if calib.num_rows else stereo
        run, tel = owner.column("run")[0].as_py(), owner.column("tel")[0].as_py()
        n = len(found_seq)
        return pa.table(
            {
                "run": pa.array([run] * n, pa.string()),
                "tel": pa.array([tel] * n, pa.string()),
                "sseq": pa.array(found_sseq, pa.int64()),
                "seq": pa.array(found_seq, pa.int64()),
            }
        )

    return walk


FUNCTION = "run string, tel string, node long, froms array<long>, tos array<long>"
PAIRS = "run string, tel string, sseq long, seq long"


def _open_rows(functions: DataFrame, last: int) -> DataFrame:
    """run, tel, node, open: the open stereo row with which each block begins, up and down the tree of blocks."""
    levels, up = [functions], F.floor(F.col("node") / FAN).cast("long").alias("_up")
    while last >= FAN:
        whole = _grouped(levels[-1].withColumn("_up", up), [*GROUP, "_up"])
        whole = whole.applyInArrow(composer(functions_of, FAN), FUNCTION)
        levels.append(written(whole, "walk-functions"))
        last //= FAN
    states = None
    for level in reversed(levels):
        if states is None:
            parts = level.select("*", up, F.lit(0).cast("long").alias("open"))
        else:
            above = states.select(*GROUP, F.col("node").alias("_up"), "open")
            parts = level.select("*", up).join(above, [*GROUP, "_up"])
        found = _grouped(parts, [*GROUP, "_up"]).applyInArrow(
            opener(functions_of), "run string, tel string, node long, open long"
        )
        states = written(found, "walk-open")
    return states


def _bounds(windows: DataFrame, calib: DataFrame, block_rows: int) -> DataFrame:
    """run, tel, block, low, high: bounds of the open stereo row with which each block of rows begins."""
    changes = [
        windows.select(*GROUP, (F.col("last") + 1).alias("block"), F.lit(1).alias("_low"), F.lit(0).alias("_high")),
        windows.select(*GROUP, (F.col("first") + 1).alias("block"), F.lit(0).alias("_low"), F.lit(1).alias("_high")),
    ]
    present = calib.select(*GROUP, block_of("seq", block_rows).alias("block"), F.lit(True).alias("_here")).distinct()
    sums = changes[0].unionByName(changes[1]).groupBy(*GROUP, "block").agg(
        F.sum("_low").alias("_low"), F.sum("_high").alias("_high")
    )
    steps = sums.join(present, [*GROUP, "block"], "full_outer").na.fill(0, ["_low", "_high"])
    before = Window.partitionBy(*GROUP).orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = steps.select(
        *GROUP, "block", "_here", F.sum("_low").over(before).alias("low"), F.sum("_high").over(before).alias("high")
    )
    return summed.filter("_here").drop("_here")


def _reached(starts: DataFrame, first, stereo: DataFrame, block_rows: int) -> DataFrame:
    """``starts`` with the stereo rows from the block ``first`` on that a block can reach."""
    # Aliases tell the columns from those of the other side of a cogroup.
    starts = starts.select(*[F.col(c).alias(c) for c in starts.columns])
    wanted = stereo.withColumn("_stereo_block", block_of("sseq", block_rows))
    reach = starts.withColumn("_stereo_block", F.explode(F.array(first, first + 1)))
    return reach.join(wanted, [*GROUP, "_stereo_block"])


def _grouped(part: DataFrame, by: Sequence[str]):
    # A few bytes of keys keep a task busy: no merging of small partitions here.
    tasks = int(part.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return part.repartition(tasks, *by).groupBy(*by)


def _walk_from(calib, stereo, starts, block_rows, keys) -> DataFrame:
    """Matched pairs of the blocks in ``starts`` (run, tel, block, open), each from its open stereo row on."""
    place = [*GROUP, "block"]
    rows = calib.withColumn("block", block_of("seq", block_rows))
    first = F.floor(F.col("open") / F.lit(block_rows)).cast("long")
    ahead = _reached(starts, first, stereo, block_rows).filter("sseq >= open")
    here = rows.join(starts.select(*place), place, "left_semi")
    pairs = _grouped(here, place).cogroup(_grouped(ahead.drop("_stereo_block"), place))
    return written(pairs.applyInArrow(walker(keys), PAIRS), "walk")


def _walk_at_once(calib, stereo, bounds, block_rows, keys) -> DataFrame:
    """Matched pairs of the runs in ``bounds``; all blocks of all runs at the same time.

    The bounds of a block are cut into pieces of ``block_rows`` beginnings, so that a task has
    one block of calibrated rows and two blocks of stereo rows, whatever the run.
    """
    spark, size = calib.sparkSession, F.lit(block_rows)
    place, calib_block = [*GROUP, "block", "piece"], [*GROUP, "block"]
    pieces = bounds.select(
        "*", F.explode(F.sequence(F.floor(F.col("low") / size), F.floor(F.col("high") / size))).alias("piece")
    ).select(
        *place,
        F.greatest("low", F.col("piece") * size).alias("begin"),
        F.least("high", F.col("piece") * size + size - 1).alias("end"),
    )
    rows = calib.withColumn("block", block_of("seq", block_rows))
    own = _grouped(pieces.join(rows, calib_block), place)
    ahead = _grouped(_reached(pieces, F.col("piece"), stereo, block_rows), place)
    functions = written(own.cogroup(ahead).applyInArrow(stepper(keys), FUNCTION), "walk-functions")
    last = functions.agg(F.max("node")).first()[0]
    if last is None:
        return spark.createDataFrame([], PAIRS)
    states = _open_rows(functions, last).filter("open >= 0").withColumnRenamed("node", "block")
    return _walk_from(calib, stereo, states, block_rows, keys)


def _walk_in_turn(calib, stereo, runs, keys, block_rows) -> DataFrame:
    """Matched pairs of ``runs``, whatever their windows; one block of calibrated rows of every run per step.

    A block matches at most as many stereo rows as it has calibrated rows, so
    each step reads a bounded slice of both sides, which are stored by block. What
    carries over to the next step is the number of the first open stereo row of each
    run; runs that end before a block take no part in it.
    """
    spark = calib.sparkSession
    path = shared_folder(spark, "walk")
    def by_block(rows: DataFrame, position: str, label: str) -> DataFrame:
        rows = rows.join(runs, list(GROUP), "left_semi").withColumn("block", block_of(position, block_rows))
        place = shared_folder(spark, label)
        rows.write.partitionBy("block").parquet(place)
        return spark.read.schema(rows.schema).parquet(place)

    calib, stereo = by_block(calib, "seq", "walk-calib"), by_block(stereo, "sseq", "walk-stereo")
    listing = calib.select("block").distinct().orderBy("block")
    blocks = [row[0] for row in listing.toLocalIterator()]
    open_rows = runs.select(*GROUP, F.lit(0).cast("long").alias("_open"))
    # A few bytes of keys keep a task busy: no merging of small partitions here.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for step, block in enumerate(blocks):
        here = calib.filter(F.col("block") == block)
        # No more stereo rows can be matched than there are calibrated rows so far.
        ahead = (
            stereo.filter(F.col("block") <= block)
            .join(open_rows, list(GROUP))
            .filter((F.col("sseq") >= F.col("_open")) & (F.col("sseq") < F.col("_open") + block_rows))
            .join(here.select(*GROUP).distinct(), list(GROUP), "left_semi")
            .drop("block")
        )
        pairs = (
            here.drop("block")
            .repartition(tasks, *GROUP)
            .groupBy(*GROUP)
            .cogroup(ahead.drop("_open").repartition(tasks, *GROUP).groupBy(*GROUP))
            .applyInArrow(walker(keys), PAIRS)
        )
        pairs.write.parquet(f"{path}/step={step}")
        if step + 1 == len(blocks):
            break
        done = spark.read.schema(PAIRS).parquet(f"{path}/step={step}")
        reached = done.groupBy(*GROUP).agg((F.max("sseq") + 1).alias("_next"))
        open_rows = written(
            open_rows.join(reached, list(GROUP), "left").select(
                *GROUP, F.coalesce("_next", "_open").alias("_open")
            ),
            "walk-open",
        )
    return spark.read.schema(PAIRS).parquet(f"{path}/step=*")


def _walk_runs(calib, stereo, mapping, runs, keys, block_rows) -> DataFrame:
    """Matched pairs of ``runs`` (run, tel, tail_equal); a run that cannot succeed may have fewer.

    A run of one block begins with the first stereo row: it is walked without bounds.
    """
    calib, stereo = (rows.join(runs.select(*GROUP), list(GROUP), "left_semi") for rows in (calib, stereo))
    blocks = calib.withColumn("_block", block_of("seq", block_rows)).groupBy(*GROUP)
    extent = listed(blocks.agg(F.min("_block").alias("block"), F.max("_block").alias("_end")), "walk-extent")
    starts = extent.filter("_end = block").select(*GROUP, "block", F.lit(0).cast("long").alias("open"))
    long_runs = extent.filter("_end > block").select(*GROUP)
    if long_runs.isEmpty():
        return _walk_from(calib, stereo, starts, block_rows, keys)
    runs = runs.join(listed(long_runs, "walk-long"), list(GROUP), "left_semi")
    pairs = _walk_long_runs(calib, stereo, mapping, runs, keys, block_rows)
    if starts.isEmpty():
        return pairs
    return pairs.unionByName(_walk_from(calib, stereo, starts, block_rows, keys))


def _walk_long_runs(calib, stereo, mapping, runs, keys, block_rows) -> DataFrame:
    """Matched pairs of ``runs`` of several blocks.

    Runs with bounds of more than :data:`WIDE` blocks of stereo rows (few different keys in very
    long runs) are walked block after block, all others at once.
    """
    calib, stereo = (rows.join(runs.select(*GROUP), list(GROUP), "left_semi") for rows in (calib, stereo))
    windows = written(_windows(calib, stereo, mapping, runs, keys, block_rows), "walk-windows")
    lost = F.max(F.coalesce(F.col("last") < F.col("first"), F.lit(True)))
    possible = windows.groupBy(*GROUP).agg(lost.alias("_lost")).filter(~F.col("_lost")).select(*GROUP)
    bounds = _bounds(windows.join(possible, list(GROUP), "left_semi"), calib, block_rows)
    bounds = listed(bounds.join(possible, list(GROUP), "left_semi"), "walk-bounds")
    width = bounds.groupBy(*GROUP).agg(F.max(F.col("high") - F.col("low")).alias("_width"))
    wide = listed(width.filter(F.col("_width") > WIDE * block_rows).select(*GROUP), "walk-wide")
    if wide.isEmpty():
        return _walk_at_once(calib, stereo, bounds, block_rows, keys)
    narrow = bounds.join(wide, list(GROUP), "left_anti")
    pairs = _walk_at_once(calib, stereo, narrow, block_rows, keys)
    return pairs.unionByName(_walk_in_turn(calib, stereo, wide, keys, block_rows))


def match_events(
    calib: DataFrame,
    stereo: DataFrame,
    keys: Sequence[str] = DATA_KEYS,
    repair_tail: bool = True,
    block_rows: int = BLOCK_ROWS,
    stored: bool = False,
) -> Match:
    """Matches ``stereo`` (run, tel, sseq, keys) against ``calib`` (run, tel, seq, keys).

    ``sseq`` counts from 0 without gaps; ``seq`` only has to increase. Statuses:
    ``ok``, ``tail_dup`` (the last stereo row repeats the one before and has no
    partner of its own: the last matched row is kept twice), ``mismatch``,
    ``empty`` (nothing matches) and ``calib_shorter``. The keys are read several
    times; ``stored`` says that both inputs are narrow tables on disk already.
    """
    calib = calib.select(*GROUP, "seq", *keys)
    stereo = stereo.select(*GROUP, "sseq", *keys)
    if not stored:
        calib, stereo = written(calib, "calib-keys"), written(stereo, "stereo-keys")
    mapping = written(_occurrence_map(calib, stereo, keys, block_rows), "match")

    n_calib = calib.groupBy(*GROUP).agg(F.count("*").alias("n_calib"))
    last_only = (F.col("n_missing") == 1) & (F.col("last_missing") == F.col("n_ref") - 1)
    repairable = last_only & F.coalesce("tail_equal", F.lit(False)) & F.lit(repair_tail)
    complete = F.col("n_missing") == 0
    increasing = F.col("n_breaks") == 0
    shape = written(
        _shape_of_map(mapping, block_rows)
        .join(n_calib, list(GROUP), "left")
        .join(_equal_tails(stereo, keys), list(GROUP), "left")
        .na.fill(0, ["n_calib"])
        .withColumn(
            "status",
            F.when(F.col("n_calib") < F.col("n_ref"), "calib_shorter")
            .when(F.col("first_missing"), "empty")
            .when(complete & increasing, "ok")
            .when(repairable & increasing, "tail_dup")
            .when(complete | repairable, "walk")
            .otherwise("mismatch"),
        ),
        "match-shape",
    )
    alone = F.coalesce("tail_equal", F.lit(False)) & F.lit(repair_tail)
    to_walk = shape.filter("status = 'walk'").select(*GROUP, alone.alias("tail_equal"))
    if not to_walk.isEmpty():
        walked = _walk_runs(calib, stereo, mapping, to_walk, keys, block_rows)
        to_walk = to_walk.select(*GROUP)
        found = walked.groupBy(*GROUP).agg(
            F.count("*").alias("_found"), F.max("seq").alias("_last_seq")
        )
        all_found = F.col("_found") == F.col("n_ref")
        but_last = (F.col("_found") == F.col("n_ref") - 1) & F.coalesce(
            "tail_equal", F.lit(False)
        ) & F.lit(repair_tail)
        open_status = F.col("status") == "walk"
        shape = shape.join(found, list(GROUP), "left").select(
            *[c for c in shape.columns if c not in ("status", "last_seq")],
            F.when(~open_status, F.col("status"))
            .when(all_found, "ok")
            .when(but_last, "tail_dup")
            .otherwise("mismatch")
            .alias("status"),
            F.when(open_status, F.col("_last_seq")).otherwise(F.col("last_seq")).alias("last_seq"),
        )
        refound = (
            stereo.select(*GROUP, "sseq")
            .join(to_walk, list(GROUP), "left_semi")
            .join(walked, [*GROUP, "sseq"], "left")
        )
        mapping = mapping.join(to_walk, list(GROUP), "left_anti").unionByName(refound)

    accepted = shape.filter(F.col("status").isin(*ACCEPTED)).select(*GROUP, "last_seq")
    kept = mapping.join(accepted, list(GROUP)).select(
        *GROUP, "sseq", F.coalesce("seq", "last_seq").alias("seq")
    )
    n_kept = F.when(F.col("status").isin(*ACCEPTED), F.col("n_ref")).otherwise(0)
    status = shape.select(
        *GROUP, "status", "n_calib", "n_ref", n_kept.cast("long").alias("n_kept")
    )
    return Match(kept, status)


# Functions of this module go to the tasks by value: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
