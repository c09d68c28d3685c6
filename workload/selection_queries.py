"""Selection of files, runs and events."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from duoscope.operators import selection as sel
from duoscope.operators.matching import match_events as match
from duoscope.operators.stereo import match_status as status_of
from duoscope.sources.events import calib_lines, key_columns
from duoscope.sources.shared import shared_folder, written
from duoscope.streaming import selecting as landed
from workload import name_queries as n
from workload import sql as q
from workload import tables as t
from workload.fixtures import write_files
from workload.registry import query
from workload.source_queries import digest

MATCH = (q.BASE, q.CALIB, q.stereo(), q.walk())
SELECT = (
    q.BASE,
    q.CALIB,
    q.VALID,
    q.COMPLETE,
    q.stereo(),
    q.USABLE,
    q.walk("usable", "wanted"),
    q.accepted(),
)
match_sql = partial(q.sql, *MATCH, recursive=True)
select_sql = partial(q.sql, *SELECT, recursive=True)


def matched(spark, sf_dir, min_value: float = 5.0):
    return match(t.calib(spark, sf_dir), t.stereo_keys(spark, sf_dir, min_value), stored=True)


def selected(spark, sf_dir):
    return sel.select_events(
        t.calib(spark, sf_dir),
        t.stereo_keys(spark, sf_dir),
        t.valid_subruns(spark, sf_dir),
        stored=True,
    )


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        select="""select run, tel, seq, subrun from calib
 where (run, subrun) in (select run, subrun from base where value > 100)""",
    )
)
def keep_valid_subruns(spark, sf_dir):
    valid = t.base(spark, sf_dir).filter("value > 100").select("run", "subrun")
    return sel.keep_valid_subruns(t.calib(spark, sf_dir), valid).select("run", "tel", "seq", "subrun")


@query(q.sql(q.BASE, q.CALIB, q.VALID, q.COMPLETE, select="select * from complete"))
def complete_runs(spark, sf_dir):
    files = t.calib(spark, sf_dir).select("run", "tel", "subrun")
    return sel.complete_runs(files, t.valid_subruns(spark, sf_dir))


@query(match_sql(select="select run, tel, sseq, seq from walk_kept"))
def match_events(spark, sf_dir):
    return matched(spark, sf_dir).kept


@query(
    match_sql(
        select="""select run, tel, status, n_calib, n_ref,
 case when status in ('ok', 'tail_dup') then n_ref else 0 end as n_kept from walk_status"""
    )
)
def match_statuses(spark, sf_dir):
    return matched(spark, sf_dir).status


@query(
    match_sql(
        select="""select k.run, k.tel, k.sseq, k.seq from walk_kept k
 join walk_status s on s.run = k.run and s.tel = k.tel and s.status = 'tail_dup'
 where k.sseq >= s.n_ref - 2"""
    )
)
def repaired_tails(spark, sf_dir):
    """The last two kept rows of repaired runs: one calibrated row, twice."""
    found = matched(spark, sf_dir)
    repaired = found.status.filter("status = 'tail_dup'").select("run", "tel", "n_ref")
    return (
        found.kept.join(repaired, ["run", "tel"])
        .filter(F.col("sseq") >= F.col("n_ref") - 2)
        .select("run", "tel", "sseq", "seq")
    )


@query(select_sql(select="select * from walk_final"))
def run_statuses(spark, sf_dir):
    return selected(spark, sf_dir).status


@query(
    select_sql(
        select="""select run, count(*) as n_rows, run in (select run from walk_good) as accepted
 from calib group by run"""
    )
)
def split_by_status(spark, sf_dir):
    accepted, other = sel.split_by_status(t.calib(spark, sf_dir), selected(spark, sf_dir).status)

    def counted(rows, flag):
        return rows.groupBy("run").agg(F.count("*").alias("n_rows")).withColumn("accepted", F.lit(flag))

    return counted(accepted, True).unionByName(counted(other, False))


@query(select_sql(select="select run, tel, sseq, seq from walk_selected"))
def select_events(spark, sf_dir):
    return selected(spark, sf_dir).kept


@query(
    select_sql(
        select="""select s.run, s.tel, s.sseq, c.nanotime, c.time2, c.id from walk_selected s
 join calib c on c.run = s.run and c.tel = s.tel and c.seq = s.seq"""
    )
)
def select_landed(spark, sf_dir):
    """The same rows while files land in two lots: a run is written when its last file is there."""
    land, out, marks = (shared_folder(spark, label) for label in ("land", "landed-selection", "landing-marks"))
    tel, run, subrun = F.col("tel"), F.col("run"), F.col("subrun")
    name = F.concat(F.lit("20240101_"), tel, F.lit("_"), run, F.lit("."), subrun, F.lit("_Y_Src.csv"))
    rows = t.calib_events(spark, sf_dir).withColumn("name", name)
    stereo, valid = t.stereo_keys(spark, sf_dir), written(t.valid_subruns(spark, sf_dir), "valid")
    for lot in (0, 1):
        here = rows.filter(F.crc32("name") % 2 == lot)
        ordered = here.repartitionByRange("name", "seq").sortWithinPartitions("name", "seq")
        write_files(calib_lines(ordered), land)
        landed.select_landed(spark, land, stereo, valid, out, marks)
    columns = ["run", "tel", "sseq", "nanotime", "time2", "id"]
    schema = "sseq long, nanotime double, time2 double, id long, run string, tel string"
    return spark.read.schema(schema).parquet(f"{out}/events").select(*columns)


@query(
    select_sql(
        select="""select c.run, c.tel, c.seq, c.event_id from calib c
 where c.run in (select run from walk_good)
  and (c.run, c.tel, c.seq) not in (select run, tel, seq from walk_selected)"""
    )
)
def rejected_events(spark, sf_dir):
    found = selected(spark, sf_dir)
    events, _ = sel.split_by_status(t.calib(spark, sf_dir), found.status)
    return sel.rejected_events(events, found.kept).select("run", "tel", "seq", "event_id")


@query(
    q.sql(
        *MATCH,
        q.stereo(8, "strict"),
        q.walk("calib", "strict_keys", "swalk"),
        select="""select coalesce(a.run, b.run) as run, coalesce(a.tel, b.tel) as tel,
 coalesce(a.seq, b.seq) as seq, b.seq is null as in_first
 from (select distinct run, tel, seq from walk_kept) a
 full join (select distinct run, tel, seq from swalk_kept) b
  on a.run = b.run and a.tel = b.tel and a.seq = b.seq
 where a.seq is null or b.seq is null""",
        recursive=True,
    )
)
def cleaning_diff(spark, sf_dir):
    loose, strict = matched(spark, sf_dir), matched(spark, sf_dir, 8.0)
    return sel.cleaning_diff(loose.kept, strict.kept)


@query(
    q.sql(
        *MATCH,
        q.stereo(8, "strict"),
        q.walk("calib", "strict_keys", "swalk"),
        q.FEATURES,
        q.CALIB_DIGEST,
        """differ as (select coalesce(a.run, b.run) as run, coalesce(a.tel, b.tel) as tel, coalesce(a.seq, b.seq) as seq
 from (select distinct run, tel, seq from walk_kept) a
 full join (select distinct run, tel, seq from swalk_kept) b
  on a.run = b.run and a.tel = b.tel and a.seq = b.seq
 where a.seq is null or b.seq is null)""",
        select="""select d.run, d.tel, d.seq, d.event_id, d.pix_sum, d.pix_moment from calib_digest d
 join differ f on f.run = d.run and f.tel = d.tel and f.seq = d.seq""",
        recursive=True,
    )
)
def events_in_diff(spark, sf_dir):
    """The events themselves on which two cleaning levels differ."""
    diff = sel.cleaning_diff(matched(spark, sf_dir).kept, matched(spark, sf_dir, 8.0).kept)
    rows = sel.events_in_diff(t.calib_events(spark, sf_dir), diff)
    return rows.select("run", "tel", "seq", "event_id", *digest()).drop("n_features")


@query(
    select_sql(
        select="""select p.run, p.seq, p.value from (select distinct run, seq0 as seq, value from base) p
 where (p.run, p.seq) in (select run, seq from walk_selected where tel = 'M1')"""
    )
)
def filter_aligned(spark, sf_dir):
    table = t.base(spark, sf_dir).select("run", F.col("seq0").alias("seq"), "value")
    return sel.filter_aligned(table, t.telescope(selected(spark, sf_dir).kept, "M1"))


PASSED = "cast(run as bigint) % 3 <> 0 and (tel = 'M1' or cast(run as bigint) % 15 <> 1)"


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        q.FILES,
        f"""passed as (select replace(name, '_M2_', '_M1_') as pair from files where {PASSED}
 group by pair having count(distinct tel) = 2)""",
        select="""select name, replace(name, '_M2_', '_M1_') in (select pair from passed) as keep from files""",
    )
)
def quality_cut(spark, sf_dir):
    files = t.file_names(spark, sf_dir).select("name", "run", "tel")
    good, bad = sel.quality_cut(files, files.filter(F.expr(PASSED)))
    return good.select("name", F.lit(True).alias("keep")).unionByName(
        bad.select("name", F.lit(False).alias("keep"))
    )


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        select="""select run, tel, seq from calib
 where run not in (select run from base where value > 480)""",
    )
)
def skip_done(spark, sf_dir):
    done = t.base(spark, sf_dir).filter("value > 480").select("run")
    return sel.skip_done(t.calib(spark, sf_dir), done).select("run", "tel", "seq")


PREDICTION_NAMES = (
    n.DATA_APPLICATION,
    n.RUN_APPLICATION,
    n.MC_VALIDATION,
    n.ONE_DOT,
    n.STACKED,
    n.ADJUSTED,
)


@query(n.expected({n.DATA_APPLICATION: "run", n.RUN_APPLICATION: "run"}, "run"))
def prediction_inputs(spark, sf_dir):
    from duoscope.functions.names import time_token
    from duoscope.operators.energy import prediction_inputs as inputs

    kept = inputs(n.listed(spark, sf_dir, PREDICTION_NAMES), "data")
    run = F.substring_index(time_token(F.col("name")), ".", 1)
    return kept.select("name", run.alias("run"))


@query(n.expected({n.MC_VALIDATION: "run"}, "run"))
def mc_prediction_inputs(spark, sf_dir):
    from duoscope.functions.names import time_token
    from duoscope.operators.energy import prediction_inputs as inputs

    kept = inputs(n.listed(spark, sf_dir, PREDICTION_NAMES), "mc")
    return kept.select("name", time_token(F.col("name")).alias("run"))


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        select="""select run, tel, seq from (select *,
  row_number() over (partition by run, tel order by seq) as rn from calib) where rn <= 10""",
    )
)
def truncate_events(spark, sf_dir):
    return sel.truncate_events(t.calib(spark, sf_dir), 10).select("run", "tel", "seq")


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        q.FILES,
        select="select name from (select name, dense_rank() over (order by name) as r from files) where r >= 100",
    )
)
def from_nth_file(spark, sf_dir):
    return sel.from_nth_file(t.file_names(spark, sf_dir).select("name"), 100)


@query(
    q.sql(
        q.BASE,
        """flagged as (select run, seq0 as seq, id,
  row_number() over (partition by run, id order by seq0) > 1 as dup from base),
 streaks as (select *, sum(case when dup then 0 else 1 end) over (partition by run order by seq) as part
  from flagged)""",
        select=f"""select run, seq, id,
 {q.r6("id + 0.01::double * (row_number() over (partition by run, part order by seq) - 1)")} as unique_id from streaks""",
    )
)
def nonduplicate_id(spark, sf_dir):
    rows = t.base(spark, sf_dir).select("run", F.col("seq0").alias("seq"), "id")
    return sel.nonduplicate_id(rows).withColumn("unique_id", F.round("unique_id", 6))


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        q.FILES,
        select=f"""select 'stereo' as list, {n.fill_sql(n.STEREO)} as name from files
  where run in (select run from files where cast(run as bigint) % 3 <> 0)
 union select 'imaged', {n.fill_sql(n.IMAGED)} from files
  where cast(run as bigint) % 3 <> 0""",
    )
)
def common_ids(spark, sf_dir):
    stereo = n.listed(spark, sf_dir, (n.STEREO,))
    runs = t.file_names(spark, sf_dir).filter(F.expr("cast(run as bigint) % 3 <> 0"))
    imaged = runs.select(n.fill(n.IMAGED).alias("name")).distinct()
    a, b = sel.common_ids(stereo, imaged)
    return a.select(F.lit("stereo").alias("list"), "name").unionByName(
        b.select(F.lit("imaged").alias("list"), "name")
    )


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        q.stereo(),
        select="""select c.run, c.tel, c.seq, c.nanotime, c.time2, c.id, s.id is not null as in_star
 from calib c left join (select distinct run, nanotime, time2, id from stereo) s
  on s.run = c.run and s.nanotime = c.nanotime and s.time2 = c.time2 and s.id = c.id""",
    )
)
def match_status(spark, sf_dir):
    star = t.stereo_events(spark, sf_dir).select("run", "nanotime", "time2", "id")
    return status_of(key_columns(t.calib(spark, sf_dir)), star, ["run", "nanotime", "time2", "id"])
