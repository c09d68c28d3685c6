"""Per-feature and per-camera statistics, counts and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duoscope.functions.arrays import log_energy
from duoscope.operators.matching import DATA_KEYS
from duoscope.sources.shared import listed, written

# Real pixels of a camera, channels of each.
REAL_PIXELS = 1039
# Sampling: bits of a hash, those that number the ranges of a sketch, and about the most rows ranked in one task.
SAMPLE_HASH_BITS = 62
SAMPLE_BITS = 16
SAMPLE_RANKED = 1000
CHANNELS = ("charge_1", "charge_2", "time_1", "time_2")


def feature_vector(events: DataFrame, mc: bool) -> Column:
    """Energy (simulation only, as logarithm), features and pointing in one array."""
    pointing = F.array(F.col("zd").cast("double"), F.col("az").cast("double"))
    parts = [F.col("pix").cast("array<double>"), pointing]
    if mc:
        parts.insert(0, F.array(log_energy(F.col("energy"))))
    return F.concat(*parts)


def feature_stats(events: DataFrame, mc: bool, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean and population standard deviation of every feature: pos, mean, std.

    Position 0 of a simulated norm is the logarithm of the energy. The values are
    combined before the shuffle, which carries one row per feature and task.
    """
    return (
        events.select(*by, F.posexplode(feature_vector(events, mc)).alias("pos", "x"))
        .groupBy(*by, "pos")
        .agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))
    )


def mean_of_file_stats(
    events: DataFrame, mc: bool, file: str = "run", mc_norm: DataFrame | None = None
) -> DataFrame:
    """Unweighted mean over files of each file's mean and std, NaN left out.

    A norm of observed events gets the energy row of ``mc_norm`` in front. The events of a file are
    brought together (``rebalance``, which splits large files) before they are taken apart into values:
    otherwise every task would send a row per file and feature, one for nearly every value.
    """
    columns = [file, *(["energy"] if mc else []), "pix", "zd", "az"]
    per_file = feature_stats(events.select(*columns).hint("rebalance", file), mc, (file,))

    def nanmean(name: str) -> Column:
        return F.avg(F.when(~F.isnan(name), F.col(name))).alias(name)

    norm = per_file.groupBy("pos").agg(nanmean("mean"), nanmean("std"))
    return norm if mc or mc_norm is None else with_mc_energy(norm, mc_norm)


def with_mc_energy(data_norm: DataFrame, mc_norm: DataFrame) -> DataFrame:
    """Moves a norm of observed events one position up and puts the energy row at 0."""
    energy = mc_norm.filter("pos = 0").select("pos", "mean", "std")
    moved = data_norm.select((F.col("pos") + 1).cast("int").alias("pos"), "mean", "std")
    return energy.unionByName(moved)


def camera_stats(norm: DataFrame, n_features: int, n_real: int = REAL_PIXELS) -> DataFrame:
    """Mean and std per channel: sums over all slots divided by the number of real pixels.

    ``norm`` is that of simulated events: features at positions 1 to ``n_features``.
    """
    features = norm.filter((F.col("pos") >= 1) & (F.col("pos") <= n_features))
    channel = ((F.col("pos") - 1) % len(CHANNELS)).cast("int")
    return features.groupBy(channel.alias("channel")).agg(
        (F.sum("mean") / n_real).alias("mean"), (F.sum("std") / n_real).alias("std")
    )


def nan_report(events: DataFrame, by: tuple[str, ...] = ("run",)) -> DataFrame:
    """Number of NaN features and of all features."""
    return events.groupBy(*by).agg(
        F.sum(F.size(F.filter("pix", lambda x: F.isnan(x)))).alias("n_nan"),
        F.sum(F.size("pix")).alias("n_values"),
    )


def rows_per_file(events: DataFrame, name: str | Column = "name") -> DataFrame:
    column = F.col(name) if isinstance(name, str) else name
    return events.groupBy(column.alias("name")).agg(F.count("*").alias("n_rows"))


def stage_shapes(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows and features per run of every named stage."""
    shapes = [
        frame.groupBy(F.lit(stage).alias("stage"), "run").agg(
            F.count("*").alias("n_rows"), F.max(F.size("pix")).alias("n_features")
        )
        for stage, frame in stages.items()
    ]
    return reduce(DataFrame.unionByName, shapes)


def stage_reconcile(shapes: DataFrame, stages: list[str]) -> DataFrame:
    """Row counts of all stages side by side; ``ok`` where no stage lost or gained rows."""
    wide = shapes.groupBy("run").pivot("stage", stages).agg(F.first("n_rows"))
    counts = [F.coalesce(F.col(s), F.lit(0)) for s in stages]
    same = reduce(lambda a, b: a & b, [c == counts[0] for c in counts[1:]], F.lit(True))
    return wide.select("run", *[c.alias(f"n_{s}") for c, s in zip(counts, stages)], same.alias("ok"))


def sample_exact(
    events: DataFrame,
    n: int,
    seed: int = 0,
    keys: tuple[str, ...] = ("run", *DATA_KEYS),
) -> DataFrame:
    """Exactly ``n`` uniformly chosen rows (all, if there are no more), the same on every run.

    Rows are chosen by a seeded hash of their keys, which must identify a row: those with
    the smallest hashes. Counts per hash range form a sketch of fixed size that tasks
    merge before the shuffle; it tells which range holds the n-th hash. All rows of
    smaller hashes are taken by a filter on the events themselves. The range that is cut
    is counted again in smaller ranges, until a handful of keys is left to be ranked.
    """
    if n <= 0:
        return events.limit(0)
    hashed = F.xxhash64(F.lit(seed), *keys)
    # The first bits, so that their order as numbers from 0 is that of the hashes.
    rank = F.shiftrightunsigned(hashed.bitwiseXOR(F.lit(-(2**63))), 64 - SAMPLE_HASH_BITS)

    def range_with(rows: DataFrame, shift: int, wanted: int):
        """The range of hashes that holds the ``wanted``-th one, its rows, and those in all ranges up to it."""
        counts = rows.groupBy(F.shiftright("_rank", shift).alias("cell")).agg(F.count("*").alias("n"))
        upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = counts.withColumn("upto", F.sum("n").over(upto))
        return summed.filter(F.col("upto") >= wanted).agg(F.min_by(F.struct("*"), "cell")).first()[0]

    shift, wanted = SAMPLE_HASH_BITS - SAMPLE_BITS, n
    ranked = events.select(*keys, rank.alias("_rank"), hashed.alias("_hash"))
    cut = range_with(ranked, shift, wanted)
    if cut is None:
        return events
    inside = written(ranked.filter(F.shiftright("_rank", shift) == cut["cell"]), "sample-range")
    wanted -= cut["upto"] - cut["n"]
    while cut["n"] > SAMPLE_RANKED and shift > 0:
        shift = max(0, shift - SAMPLE_BITS)
        cut = range_with(inside, shift, wanted)
        inside = inside.filter(F.shiftright("_rank", shift) == cut["cell"])
        wanted -= cut["upto"] - cut["n"]
    place = F.row_number().over(Window.orderBy("_hash", *keys))
    last = inside.withColumn("_place", place).filter(F.col("_place") <= wanted)
    last = last.select(*[F.col(k).alias(f"_chosen_{k}") for k in keys], F.lit(True).alias("_chosen"))
    here = F.shiftright(rank, shift)
    border = events.filter(here <= cut["cell"])
    same = here == cut["cell"]
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_chosen_{key}"))
    found = border.join(listed(last, "sample-chosen"), same, "left")
    return found.filter((here < cut["cell"]) | F.col("_chosen")).select(*events.columns)
