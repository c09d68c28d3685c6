"""Joins of the two telescopes into stereo rows, and the checks around them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope.functions.arrays import interleave
from duoscope.operators.matching import DATA_KEYS, MC_KEYS, without_nan_keys
from duoscope.operators.ordering import block_of, number_rows
from duoscope.sources.events import bucket_count, write_event_buckets
from duoscope.sources.shared import listed, written

CARRIED = ("nanotime", "time2", "id", "energy", "zd", "az")
REPEATED = "n_1 > 1 or n_2 > 1"
QUARANTINES = ("run", "keys")
# Of so many runs a list is sent to all tasks (some tens of MB).
LISTED_RUNS = 500_000


@dataclass(frozen=True)
class Stereo:
    """Stereo rows of the accepted runs, the status of every run, and for key joins the repeated keys."""

    rows: DataFrame
    status: DataFrame
    repeated: DataFrame | None = None


def positions(events: DataFrame, order: str = "seq") -> DataFrame:
    """run, tel, sseq, seq: the k-th row of each run and telescope, for inputs without a stereo list.

    Computed on the keys alone; pass the result to :func:`stereo_of_kept`.
    """
    keys = events.select("run", "tel", F.col(order).alias("seq"))
    return written(number_rows(keys, ["run", "tel"], [block_of("seq")], ["seq"], "sseq"), "positions")


def key_counts(m1: DataFrame, m2: DataFrame, keys: Sequence[str]) -> DataFrame:
    """run, keys, n_1, n_2: how often every key occurs in each telescope; rows are not joined."""
    join = ["run", *keys]

    def counted(events: DataFrame, name: str) -> DataFrame:
        return without_nan_keys(events.select(*join), keys).groupBy(*join).agg(F.count("*").alias(name))

    return counted(m1, "n_1").join(counted(m2, "n_2"), join, "full_outer").na.fill(0, ["n_1", "n_2"])


def _per_run(counts: DataFrame) -> DataFrame:
    return counts.groupBy("run").agg(
        F.sum("n_1").alias("n_1"),
        F.sum("n_2").alias("n_2"),
        F.sum(F.col("n_1") * F.col("n_2")).alias("n_joined"),
        F.count_if(F.expr(REPEATED)).alias("n_repeated"),
    )


def key_growth(m1: DataFrame, m2: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per run of both telescopes and of their join on ``keys``, without joining rows.

    A key that occurs a times in M1 and b times in M2 gives a * b rows. ``ok`` says that
    the join is no longer than the longer telescope. That alone does not rule out
    wrong pairs: see :func:`key_status`.
    """
    sums = _per_run(key_counts(m1, m2, keys)).drop("n_repeated")
    return sums.withColumn("ok", F.col("n_joined") <= F.greatest("n_1", "n_2"))


def repeated_keys(m1: DataFrame, m2: DataFrame, keys: Sequence[str]) -> DataFrame:
    """run, keys, n_1, n_2 of the keys that occur more than once in a telescope: no pair of them is certain."""
    return key_counts(m1, m2, keys).filter(REPEATED)


def _key_status(counts: DataFrame, quarantine: str) -> DataFrame:
    sums = _per_run(counts)
    missing = (F.col("n_1") == 0) | (F.col("n_2") == 0)
    held = F.when(F.col("n_repeated") > 0, "repeated_keys" if quarantine == "run" else "keys_held_back")
    named = F.when(missing, "missing_partner").otherwise(F.coalesce(held, F.lit("ok")))
    return sums.withColumn("status", F.coalesce(held, named) if quarantine == "run" else named)


def key_status(m1: DataFrame, m2: DataFrame, keys: Sequence[str], quarantine: str = "run") -> DataFrame:
    """Per run the sizes of :func:`key_growth`, the number of repeated keys, and a ``status``.

    Both telescopes must be free of repeated keys: one key that occurs twice in either of
    them makes the run ``repeated_keys``, however short its join is, as repeats can hide behind
    events without a partner. Else a run is ``missing_partner`` or ``ok``. With
    ``quarantine="keys"`` only the events with such keys are held back, and the run is
    ``keys_held_back``.
    """
    if quarantine not in QUARANTINES:
        raise ValueError(f"quarantine must be one of {QUARANTINES}, not {quarantine}")
    return _key_status(key_counts(m1, m2, keys), quarantine)


def last_rows(kept: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """The last two rows of every run and telescope, found on the narrow ``kept`` table."""
    if ends is None:
        ends = kept.groupBy("run", "tel").agg(F.max("sseq").alias("_end"))
    last = kept.join(ends.select("run", "tel", "_end"), ["run", "tel"])
    return last.filter(F.col("sseq") >= F.col("_end") - 1).drop("_end")


def position_status(events: DataFrame, kept: DataFrame) -> DataFrame:
    """Whether the rows of a run may be paired by position: run, n_1, n_2, tail flags, ``status``.

    Both telescopes need as many rows, and their last two rows must be equal on
    both or on neither: ``missing_partner``, ``length_differs``, ``tails_differ`` or
    ``ok``. Features are read for the last two rows of a run alone.
    """
    ends = kept.groupBy("run", "tel").agg(F.max("sseq").alias("_end"), F.count("*").alias("_n"))
    last = last_rows(kept, ends)
    columns = [c for c in (*CARRIED, "pix") if c in events.columns]
    tails = listed(
        events.select("run", "tel", "seq", *columns).join(
            last.select("run", "tel", "seq", "sseq"), ["run", "tel", "seq"]
        ),
        "tails",
    )
    tel = F.col("tel")

    def rows_of(name: str) -> Column:
        return F.coalesce(F.max(F.when(tel == name, F.col("_n"))), F.lit(0))

    counts = ends.groupBy("run").agg(rows_of("M1").alias("n_1"), rows_of("M2").alias("n_2"))
    equal = tail_duplicate(tails, columns)
    differ = ~F.col("tail_dup_1").eqNullSafe(F.col("tail_dup_2"))
    return counts.join(equal.drop("agree"), "run", "left").withColumn(
        "status",
        F.when((F.col("n_1") == 0) | (F.col("n_2") == 0), "missing_partner")
        .when(F.col("n_1") != F.col("n_2"), "length_differs")
        .when(differ, "tails_differ")
        .otherwise("ok"),
    )


def accepted_rows(rows: DataFrame, status: DataFrame) -> DataFrame:
    good = F.col("status").isin("ok", "keys_held_back")
    return rows.join(status.filter(good).select("run"), "run", "left_semi")


def stereo_join(
    m1: DataFrame, m2: DataFrame, on: str = "position", keys_from: str = "M1", quarantine: str = "run"
) -> Stereo:
    """One row per stereo event with interleaved features, and a status per run.

    ``on="time"`` joins observed events on their keys, ``on="mc"`` simulated ones,
    ``on="position"`` joins the k-th rows of both telescopes by the ``sseq`` they
    carry (see :func:`stereo_of_kept` for rows that do not). Keys and pointing come from ``keys_from``:
    usually M1 for observed and M2 for simulated events. Only runs with status ``ok``
    are joined: see :func:`key_status`, under which every joined key occurs once in each
    telescope, and :func:`position_status`, under which no row meets another's partner.
    A repeated key holds up its run, or with ``quarantine="keys"`` its own events alone;
    ``repeated`` lists such keys.
    """
    if quarantine not in QUARANTINES:
        raise ValueError(f"quarantine must be one of {QUARANTINES}, not {quarantine}")
    if keys_from not in ("M1", "M2"):
        raise ValueError(f"keys_from must be M1 or M2, not {keys_from}")
    keys = {"time": DATA_KEYS, "mc": MC_KEYS, "position": ("sseq",)}.get(on)
    if keys is None:
        raise ValueError(f"on must be time, mc or position, not {on}")
    if on == "position":
        both = m1.unionByName(m2, allowMissingColumns=True).withColumn("seq", F.col("sseq"))
        status = position_status(both, both.select("run", "tel", "sseq", "seq"))
        left, right, repeated = m1, m2, None
    else:
        counts = written(key_counts(m1, m2, keys), "key-counts")
        status, repeated = _key_status(counts, quarantine), counts.filter(REPEATED)
        left, right = without_nan_keys(m1, keys), without_nan_keys(m2, keys)
    status = listed(status, "stereo-status")
    left, right = accepted_rows(left, status), accepted_rows(right, status)
    join = ["run", *keys]
    if repeated is not None and quarantine == "keys":
        # A key that is held back on one side finds no partner on the other.
        left = left.join(listed(repeated.select(*join), "repeated-keys"), join, "left_anti")
    owner, other = (left, right) if keys_from == "M1" else (right, left)
    carried = [c for c in CARRIED if c in owner.columns and c not in join]
    positions = [c for c in ("sseq",) if c in owner.columns and c not in join]
    a = owner.select(*join, *positions, *carried, F.col("pix").alias("_own"))
    b = other.select(*join, F.col("pix").alias("_other"))
    pix = ("_own", "_other") if keys_from == "M1" else ("_other", "_own")
    rows = a.join(b, join).select(*join, *positions, *carried, interleave(*pix).alias("pix"))
    return Stereo(rows, status, repeated)


def attach_position(events: DataFrame, kept: DataFrame) -> DataFrame:
    """Selected events with ``sseq``; a row kept twice appears twice."""
    return events.join(kept, ["run", "tel", "seq"])


def of_kept_runs(events: DataFrame, kept: DataFrame) -> DataFrame:
    """``events`` without those of runs that have no kept row, left out before any shuffle.

    With more than :data:`LISTED_RUNS` runs all events are given back: a shuffle of the features by
    run would cost more than it saves.
    """
    runs = listed(kept.select("run").distinct(), "kept-runs")
    if runs.count() > LISTED_RUNS:
        return events
    return events.join(F.broadcast(runs), "run", "left_semi")


def stereo_of_kept(events: DataFrame, kept: DataFrame, keys_from: str = "M1") -> DataFrame:
    """Stereo rows of selected events, with few shuffles of the features.

    Events of runs without kept rows stay out (see :func:`of_kept_runs`).
    The positions of both telescopes are paired on the narrow ``kept`` table. M2
    rows then look up their partner's position and join the M1 rows there, so M1
    features move once and M2 features twice. On an event table bucketed by run,
    tel and seq M1 features stay in place and M2 features move once.
    """
    tel = F.col("tel")
    k1 = kept.filter(tel == "M1").select("run", "sseq", "tel", "seq")
    k2 = kept.filter(tel == "M2").select(
        "run", "sseq", F.col("tel").alias("_tel2"), F.col("seq").alias("_seq2")
    )
    pairs = k1.join(k2, ["run", "sseq"])
    events = of_kept_runs(events, kept)
    carried = [c for c in CARRIED if c in events.columns]
    m1 = events.filter(tel == "M1").select("run", "tel", "seq", *carried, F.col("pix").alias("_pix1"))
    m2 = events.filter(tel == "M2").select(
        "run",
        F.col("tel").alias("_tel2"),
        F.col("seq").alias("_seq2"),
        *[F.col(c).alias(f"_m2_{c}") for c in carried],
        F.col("pix").alias("_pix2"),
    )
    right = m2.join(pairs, ["run", "_tel2", "_seq2"]).drop("_tel2", "_seq2")
    own = [F.col(c) if keys_from == "M1" else F.col(f"_m2_{c}").alias(c) for c in carried]
    return m1.join(right, ["run", "tel", "seq"]).select(
        "run", "sseq", *own, interleave("_pix1", "_pix2").alias("pix")
    )


def stereo_of_positions(selected: DataFrame, keys_from: str = "M1") -> DataFrame:
    """Stereo rows of a table of selected events that carry their position ``sseq``.

    From a table bucketed by run and position (:func:`write_selected`) both telescopes lie
    together already: no features move. In other tables each moves once.
    """
    carried = [c for c in CARRIED if c in selected.columns]
    sides = {"M1": ("_pix1", []), "M2": ("_pix2", [])}
    sides[keys_from] = (sides[keys_from][0], carried)
    m1, m2 = (
        selected.filter(F.col("tel") == tel).select("run", "sseq", *own, F.col("pix").alias(pix))
        for tel, (pix, own) in sides.items()
    )
    return m1.join(m2, ["run", "sseq"]).select("run", "sseq", *carried, interleave("_pix1", "_pix2").alias("pix"))


def write_selected(
    events: DataFrame, kept: DataFrame, table: str, buckets: int | None = None, path: str | None = None
) -> DataFrame:
    """Selected events with their position, as a table bucketed by run and position for both telescopes.

    Positions are assigned here, once; every later stereo join of the table leaves the features
    where they are. Without ``buckets`` the kept rows, which are narrow, are counted. ``path`` is
    where the table lies, the warehouse without one.
    """
    buckets = bucket_count(kept) if buckets is None else buckets
    return write_event_buckets(attach_position(events, kept), table, buckets, ("run", "sseq"), path)


def tail_duplicate(events: DataFrame, columns: Sequence[str], order: str = "sseq") -> DataFrame:
    """Per run and telescope whether the last two rows are equal; ``agree`` compares the telescopes."""
    ends = listed(events.groupBy("run", "tel").agg(F.max(order).alias("_end")), "ends")
    tail = events.join(ends, ["run", "tel"]).filter(F.col(order) >= F.col("_end") - 1)
    whole = F.struct(*columns)
    tails = tail.groupBy("run", "tel").agg(
        (F.count("*") == 2).alias("_two"), F.min(whole).alias("_a"), F.max(whole).alias("_b")
    )
    flags = tails.select("run", "tel", (F.col("_two") & (F.col("_a") == F.col("_b"))).alias("dup"))
    return flags.groupBy("run").agg(
        F.max(F.when(F.col("tel") == "M1", F.col("dup"))).alias("tail_dup_1"),
        F.max(F.when(F.col("tel") == "M2", F.col("dup"))).alias("tail_dup_2"),
        (F.min("dup") == F.max("dup")).alias("agree"),
    )


def duplicate_count(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per run that repeat an earlier one in all ``columns``.

    Rows count as equal if two 64-bit hashes of their columns are, from different
    seeds: the features are read once and never shuffled, and the counts are combined
    before the shuffle.
    """
    hashes = [F.xxhash64(F.lit(seed), *columns).alias(f"_h{seed}") for seed in (1, 2)]
    return (
        events.select("run", *hashes)
        .groupBy("run", "_h1", "_h2")
        .agg(F.count("*").alias("_n"))
        .groupBy("run")
        .agg(F.sum("_n").alias("n_rows"), F.sum(F.col("_n") - 1).alias("n_duplicates"))
    )


def join_growth(m1: DataFrame, m2: DataFrame, joined: DataFrame, exact: bool = False) -> DataFrame:
    """Row counts per run before and after a join, and whether the result is short enough."""
    n1 = m1.groupBy("run").agg(F.count("*").alias("n_1"))
    n2 = m2.groupBy("run").agg(F.count("*").alias("n_2"))
    n = joined.groupBy("run").agg(F.count("*").alias("n_joined"))
    counts = n1.join(n2, "run", "full_outer").join(n, "run", "left").na.fill(0)
    longest = F.greatest("n_1", "n_2")
    fits = F.col("n_joined") == longest if exact else F.col("n_joined") <= longest
    return counts.withColumn("ok", fits)


def width_mismatch(events: DataFrame) -> DataFrame:
    """Feature counts per run: the telescopes must have one and the same width."""
    width = F.size("pix")
    tel = F.col("tel")
    return events.groupBy("run").agg(
        F.max(F.when(tel == "M1", width)).alias("width_1"),
        F.max(F.when(tel == "M2", width)).alias("width_2"),
        (F.min(width) == F.max(width)).alias("ok"),
    )


def pair_with_indicator(m1: DataFrame, m2: DataFrame, key: str = "id") -> DataFrame:
    """Rows of M1 by run, split into those with and without a partner in M2.

    Both sides are counted per key first, so a frequent key is one row of each.
    """
    own = m1.groupBy("run", key).agg(F.count("*").alias("_own"))
    partners = m2.groupBy("run", key).agg(F.count("*").alias("_partners"))
    alone = F.when(F.col("_partners").isNull(), F.col("_own")).otherwise(0)
    return (
        own.join(partners, ["run", key], "left")
        .groupBy("run")
        .agg(
            F.coalesce(F.sum(F.col("_own") * F.col("_partners")), F.lit(0)).alias("n_both"),
            F.sum(alone).alias("n_left_only"),
        )
    )


def match_status(calib: DataFrame, star: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Calibrated rows with a flag: does a row with the same ``columns`` survive cleaning?"""
    present = without_nan_keys(star, columns).select(*columns).distinct()
    flagged = present.withColumn("_hit", F.lit(True))
    return calib.join(flagged, list(columns), "left").select(
        *calib.columns, F.coalesce("_hit", F.lit(False)).alias("in_star")
    )
