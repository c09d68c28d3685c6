"""Moments of features as stored states: one row of arrays per run, added to as runs arrive.

A state holds for every feature the number of values, their mean and the sum of
squared deviations from it. Tasks fold Arrow batches of events into states; states are
merged pairwise, so no square of a large mean is ever subtracted from another. A norm
over many runs reads their states alone, never their events.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope.operators.statistics import feature_vector, with_mc_energy
from duoscope.sources.shared import written

STATE = "run string, n array<long>, mean array<double>, m2 array<double>"
#: States of one run that a task merges at once; there are as many rounds as powers of it.
FAN_IN = 32
#: Values of the events that are folded at once.
FOLDED = 1 << 20


def _merge(a, b):
    """The state of two sets of values; the shorter one has none at the positions it lacks."""
    if len(a[0]) < len(b[0]):
        a, b = b, a
    n, mean, m2 = (x.copy() for x in a)
    k = len(b[0])
    total = n[:k] + b[0]
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        share = np.where(total > 0, b[0] / np.maximum(total, 1), 0.0)
        shift = b[1] - mean[:k]
        # Means that are not finite have no distance: their sum is the mean, and no deviation is known.
        near = np.isfinite(shift)
        both_m2 = np.where(near, m2[:k] + b[2] + shift**2 * share * n[:k], np.nan)
        both_mean = np.where(near, mean[:k] + shift * share, mean[:k] + b[1])
        # Where one side has no values the other stands as it is, whatever its numbers.
        m2[:k] = np.where(b[0] == 0, m2[:k], np.where(n[:k] == 0, b[2], both_m2))
        mean[:k] = np.where(b[0] == 0, mean[:k], np.where(n[:k] == 0, b[1], both_mean))
    n[:k] = total
    return n, mean, m2


def _of_values(values):
    """State of rows of equal width; null is NaN with a mask."""
    data, valid = values
    n = valid.sum(axis=0)
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        mean = np.where(valid, data, 0.0).sum(axis=0) / np.maximum(n, 1)
        m2 = np.where(valid, (data - mean) ** 2, 0.0).sum(axis=0)
    return n.astype("i8"), mean, m2


def _batch_of(rows, part):
    """Arrow rows of ``{run: state}``."""
    states = list(rows.values())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(rows), pa.string()),
            pa.array([s[0] for s in states], pa.list_(pa.int64())),
            pa.array([s[1] for s in states], pa.list_(pa.float64())),
            pa.array([s[2] for s in states], pa.list_(pa.float64())),
            pa.array([part] * len(states), pa.int64()),
        ],
        ["run", "n", "mean", "m2", "part"],
    )


def _folder(merge, of_values, batch_of, folded, most_runs):
    """Arrow function from (run, x) rows to states; refers to nothing that workers would import."""

    def fold(batches):
        from pyspark import TaskContext

        part, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            runs = batch.column("run").dictionary_encode()
            names, codes = runs.dictionary.to_pylist(), runs.indices.fill_null(-1).to_numpy()
            x = batch.column("x")
            lengths = x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = x.flatten()
            valid = flat.is_valid().to_numpy(zero_copy_only=False)
            data = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype("i8") if len(lengths) else lengths
            for code in np.unique(codes):
                name = names[code] if code >= 0 else None
                for width in np.unique(lengths[codes == code]):
                    rows = np.flatnonzero((codes == code) & (lengths == width))
                    step = max(1, folded // max(1, int(width)))
                    for a in range(0, len(rows), step):
                        at = starts[rows[a : a + step], None] + np.arange(width)
                        state = of_values((data[at], valid[at]))
                        held[name] = merge(held[name], state) if name in held else state
            if len(held) > most_runs:
                yield batch_of(held, part)
                held = {}
        if held:
            yield batch_of(held, part)

    return fold


def _merger(merge, batch_of, whole: bool):
    """Arrow function that merges neighbouring states of one run and ``next``, or with ``whole`` all of a task."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        key, state = None, None
        for batch in batches:
            arrays = (batch.column(c) for c in ("run", "next", "n", "mean", "m2"))
            for name, number, *values in zip(*arrays):
                new_key = (None, part) if whole else (name.as_py(), number.as_py())
                new = tuple(x.values.to_numpy(zero_copy_only=False) for x in values)
                if state is not None and new_key == key:
                    state = merge(state, new)
                    continue
                if state is not None:
                    yield batch_of({key[0]: state}, key[1])
                key, state = new_key, new
        if state is not None:
            yield batch_of({key[0]: state}, key[1])

    return run


def _merged(states: DataFrame) -> DataFrame:
    """One state per run. Rounds of :data:`FAN_IN` numbers of ``part`` each; a task holds one state at a time."""
    tasks = int(states.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = states.agg(F.max("part")).first()[0] or 0
    function = _merger(_merge, _batch_of, whole=False)
    while True:
        last //= FAN_IN
        step = states.withColumn("next", F.floor(F.col("part") / FAN_IN).cast("long"))
        dealt = step.repartition(tasks, "run", "next").sortWithinPartitions("run", "next")
        states = written(dealt.mapInArrow(function, f"{STATE}, part long"), "moments")
        if last == 0:
            return states.drop("part")


def merged(states: DataFrame) -> DataFrame:
    """A single state, of run null, for all runs."""
    whole = _merger(_merge, _batch_of, whole=True)
    numbered = states.withColumn("next", F.lit(0).cast("long"))
    return _merged(written(numbered.mapInArrow(whole, f"{STATE}, part long"), "moments"))


def run_moments(events: DataFrame, mc: bool, most_runs: int = 256) -> DataFrame:
    """run, n, mean, m2: one state per run over :func:`feature_vector`; null values are left out, NaN counts.

    Each task sends one state per run it meets, instead of a row per value. Rows of
    different widths may share a run.
    """
    rows = events.select("run", feature_vector(events, mc).alias("x"))
    fold = _folder(_merge, _of_values, _batch_of, FOLDED, most_runs)
    states = written(rows.mapInArrow(fold, f"{STATE}, part long"), "moments")
    return _merged(states)


def add_runs(events: DataFrame, path: str, mc: bool) -> DataFrame:
    """Adds the states of the runs of ``events`` to the table at ``path``; runs met again replace theirs.

    Other runs stay, and their events are not read. Returns all states.
    """
    states = run_moments(events, mc)
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    return read_moments(events.sparkSession, path)


def read_moments(spark: SparkSession, path: str) -> DataFrame:
    names = [field.split(" ")[0] for field in STATE.split(", ")]
    return spark.read.schema(STATE).parquet(path).select(*names)


def norm_of(states: DataFrame) -> DataFrame:
    """pos, mean, std over all values of all runs: what ``feature_stats`` gives for their events."""
    std = F.sqrt(F.col("_s.m2") / F.col("_s.n"))
    rows = merged(states).select(F.posexplode(F.arrays_zip("n", "mean", "m2")).alias("pos", "_s")).filter("_s.n > 0")
    return rows.select("pos", F.col("_s.mean").alias("mean"), std.alias("std"))


def mean_of_runs(states: DataFrame, mc: bool = False, mc_norm: DataFrame | None = None) -> DataFrame:
    """pos, mean, std: the unweighted mean over runs of each run's mean and std, NaN left out."""
    rows = states.select(F.posexplode(F.arrays_zip("n", "mean", "m2")).alias("pos", "_s")).filter("_s.n > 0")
    std = F.sqrt(F.col("_s.m2") / F.col("_s.n"))

    def nanmean(value, name: str):
        return F.avg(F.when(~F.isnan(value), value)).alias(name)

    norm = rows.groupBy("pos").agg(nanmean(F.col("_s.mean"), "mean"), nanmean(std, "std"))
    return norm if mc or mc_norm is None else with_mc_energy(norm, mc_norm)


# Functions of this module go to the tasks by value: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
