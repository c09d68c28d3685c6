"""Which files, runs and events take part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duoscope.functions import names
from duoscope.operators.matching import (
    ACCEPTED,
    DATA_KEYS,
    GROUP,
    Match,
    match_events,
)
from duoscope.operators.ordering import (
    BLOCK_ROWS,
    block_of,
    number_list,
    number_rows,
    running_max,
    with_occurrence,
)
from duoscope.sources.shared import listed, written


def keep_valid_subruns(events: DataFrame, valid: DataFrame) -> DataFrame:
    """Rows of the run/subrun pairs that exist after cleaning."""
    pairs = valid.select("run", "subrun").distinct()
    return events.join(pairs, ["run", "subrun"], "left_semi")


def complete_runs(files: DataFrame, valid: DataFrame) -> DataFrame:
    """Per run and telescope: files present, valid subruns, and whether none is missing.

    ``files`` has run, tel, subrun. Both telescopes of every valid run are listed.
    """
    present = files.groupBy(*GROUP).agg(F.count_distinct("subrun").alias("n_files"))
    wanted = valid.groupBy("run").agg(F.count_distinct("subrun").alias("n_valid"))
    both = wanted.select("*", F.explode(F.array(F.lit("M1"), F.lit("M2"))).alias("tel"))
    counted = both.join(present, list(GROUP), "left").na.fill(0, ["n_files"])
    return counted.select(
        *GROUP, "n_files", "n_valid", (F.col("n_files") >= F.col("n_valid")).alias("complete")
    )


def run_status(match: Match, completeness: DataFrame | None = None, stereo: DataFrame | None = None) -> DataFrame:
    """Status per run and telescope, with the partner's failure taken into account.

    A run is accepted only when both telescopes are.
    """
    status = match.status
    if completeness is not None:
        listed = stereo.groupBy(*GROUP).agg(F.count("*").alias("n_ref"))
        missing = completeness.filter(~F.col("complete")).select(*GROUP)
        lost = listed.join(missing, list(GROUP), "left_semi").select(
            *GROUP,
            F.lit("missing_files").alias("status"),
            F.lit(None).cast("long").alias("n_calib"),
            "n_ref",
            F.lit(0).cast("long").alias("n_kept"),
        )
        status = status.unionByName(lost)
    pair = Window.partitionBy("run")  # two rows: one per telescope
    own = F.col("status").isin(*ACCEPTED)
    both = (F.count_if(own).over(pair) == 2) & (F.count("*").over(pair) == 2)
    same = F.min("n_kept").over(pair) == F.max("n_kept").over(pair)
    return status.withColumn("_good", both & same).select(
        *GROUP,
        F.when(own & ~F.col("_good"), "partner_failed").otherwise(F.col("status")).alias("status"),
        "n_calib",
        "n_ref",
        F.when(F.col("_good"), F.col("n_kept")).otherwise(0).alias("n_kept"),
    )


def split_by_status(events: DataFrame, status: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events of accepted runs, and those of all other runs."""
    accepted = listed(
        status.filter(F.col("status").isin(*ACCEPTED)).select("run").distinct(), "accepted"
    )
    return events.join(accepted, "run", "left_semi"), events.join(accepted, "run", "left_anti")


def rejected_events(events: DataFrame, kept: DataFrame) -> DataFrame:
    """Events that cleaning threw out."""
    return events.join(kept, [*GROUP, "seq"], "left_anti")


def cleaning_diff(kept_a: DataFrame, kept_b: DataFrame) -> DataFrame:
    """run, tel, seq of events that exactly one of two cleaning levels keeps."""
    on = [*GROUP, "seq"]
    a = kept_a.select(*on).distinct().withColumn("_a", F.lit(1))
    b = kept_b.select(*on).distinct().withColumn("_b", F.lit(1))
    return (
        a.join(b, on, "full_outer")
        .filter(F.col("_a").isNull() | F.col("_b").isNull())
        .select(*on, F.col("_a").isNotNull().alias("in_first"))
    )


def events_in_diff(events: DataFrame, diff: DataFrame) -> DataFrame:
    """The events, features included, that exactly one of two cleaning levels keeps."""
    return events.join(diff, [*GROUP, "seq"], "left_semi")


def filter_aligned(table: DataFrame, kept: DataFrame, on: Sequence[str] = ("run", "seq")) -> DataFrame:
    """Rows of another table that is aligned with the calibrated rows."""
    return table.join(kept, list(on), "left_semi")


def quality_cut(files: DataFrame, passed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files whose name passed the quality cuts on both telescopes, and the others.

    ``name`` columns differ between the telescopes only in the telescope token.
    """
    as_m1 = F.regexp_replace("name", "_M2_", "_M1_")
    tel = names.telescope_of(F.col("name"))
    good = (
        passed.filter(tel == "M1").select("name").intersect(passed.filter(tel == "M2").select(as_m1))
    ).withColumnRenamed("name", "_pair")
    keyed = files.withColumn("_pair", as_m1)
    return (
        keyed.join(good, "_pair", "left_semi").drop("_pair"),
        keyed.join(good, "_pair", "left_anti").drop("_pair"),
    )


def skip_done(events: DataFrame, done: DataFrame, on: Sequence[str] = ("run",)) -> DataFrame:
    """Events of runs that the output does not hold yet."""
    return events.join(listed(done.select(*on).distinct(), "done"), list(on), "left_anti")


def truncate_events(events: DataFrame, n: int, by: Sequence[str] = GROUP, order: str = "seq") -> DataFrame:
    """The first ``n`` rows of every file group, found on the keys alone."""
    keys = events.select(*by, order)
    first = number_rows(keys, by, [block_of(order)], [order], "_row").filter(F.col("_row") < n)
    return events.join(first.drop("_row"), [*by, order], "left_semi")


def from_nth_file(files: DataFrame, n: int, name: str = "name") -> DataFrame:
    """The n-th file by name (counting from 1) and all that follow."""
    numbered = number_list(files.select(name).distinct(), name, "_index")
    late = numbered.filter(F.col("_index") >= n - 1).select(name)
    return files.join(late, name, "left_semi")


def nonduplicate_id(events: DataFrame, id_column: str = "id", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``unique_id``: the id plus 0.01 for every row of the current streak of repeats.

    A row is a repeat when its run already had the id; the streak ends at the
    first row that is not. ``seq`` must count without gaps.
    """
    flagged = with_occurrence(events, ["run"], [id_column], "seq", block_rows, "_occ")
    last_new = running_max(
        flagged, ["run"], "seq", F.when(F.col("_occ") == 1, F.col("seq")), "_new", block_rows
    )
    streak = F.col("seq") - F.col("_new")
    return last_new.select(
        *events.columns, (F.col(id_column) + F.lit(0.01).cast("double") * streak).alias("unique_id")
    )


def common_ids(left: DataFrame, right: DataFrame, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """Both file lists, reduced to the ids they share."""
    key = names.id_of(F.col(name)).alias("_id")
    a, b = left.select("*", key), right.select("*", key)
    return (
        a.join(b.select("_id").distinct(), "_id", "left_semi").drop("_id"),
        b.join(a.select("_id").distinct(), "_id", "left_semi").drop("_id"),
    )


def select_events(
    events: DataFrame,
    stereo: DataFrame,
    valid: DataFrame | None = None,
    keys: Sequence[str] = DATA_KEYS,
    repair_tail: bool = True,
    block_rows: int = BLOCK_ROWS,
    stored: bool = False,
) -> Match:
    """Valid subruns, complete runs, ordered match, acceptance of whole runs.

    Returns the kept rows (run, tel, sseq, seq) of accepted runs and the status of
    every run, both as tables on disk. Only key columns take part; join the result
    to the events with :func:`duoscope.operators.stereo.attach_position`.

    The keys are read several times. With ``stored`` both inputs are tables on disk,
    whose key columns are cheap to read again; otherwise the keys are written first.
    """
    columns = [c for c in (*GROUP, "subrun", "seq", *keys) if c in events.columns]
    narrow, stereo = events.select(*columns), stereo.select(*GROUP, "sseq", *keys)
    if not stored:
        narrow, stereo = written(narrow, "calib-keys"), written(stereo, "stereo-keys")
    completeness, wanted = None, stereo
    if valid is not None:
        pairs = listed(valid.select("run", "subrun").distinct(), "valid")
        files = keep_valid_subruns(narrow.select(*GROUP, "subrun").distinct(), pairs)
        completeness = listed(complete_runs(files, pairs), "complete")
        if completeness.filter("n_files > 0").isEmpty():
            raise ValueError("no events left in valid subruns")
        usable = listed(completeness.filter("complete").select(*GROUP), "usable")
        files = listed(pairs.join(usable, "run"), "usable-files")
        # The match reads the keys several times: they are joined to the lists once.
        narrow = narrow.join(files, [*GROUP, "subrun"], "left_semi").drop("subrun")
        wanted = stereo.join(usable, list(GROUP), "left_semi")
        narrow, wanted = written(narrow, "usable-keys"), written(wanted, "usable-stereo")
    match = match_events(narrow, wanted, keys, repair_tail, block_rows, stored=True)
    status = listed(run_status(match, completeness, stereo), "status")
    accepted = status.filter(F.col("status").isin(*ACCEPTED)).select(*GROUP)
    return Match(written(match.kept.join(accepted, list(GROUP), "left_semi"), "kept"), status)
