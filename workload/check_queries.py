"""Consistency checks, batches, run lists and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from duoscope.operators import files as fi
from duoscope.operators import statistics as stt
from workload import sql as q
from workload import tables as t
from workload.registry import query
from workload.selection_queries import select_sql, selected

FILE_PARTS = (q.BASE, q.CALIB, q.FILES)


@query(
    q.sql(
        *FILE_PARTS,
        select="""select replace(name, '_M1_', '_M2_') as key, bool_or(tel = 'M1') as in_left,
 bool_or(tel = 'M2') as in_right from files group by key having count(distinct tel) < 2""",
    )
)
def unpaired_files(spark, sf_dir):
    files = t.file_names(spark, sf_dir)
    return fi.unpaired_files(t.telescope(files, "M1"), t.telescope(files, "M2"))


@query(
    q.sql(
        *FILE_PARTS,
        select="""select replace(name, '_M1_', '_M2_') as name, 'M2' as missing_from from files a where tel = 'M1'
  and not exists (select 1 from files b where b.run = a.run and b.subrun = a.subrun and b.tel = 'M2')
 union all select replace(name, '_M2_', '_M1_'), 'M1' from files a where tel = 'M2'
  and not exists (select 1 from files b where b.run = a.run and b.subrun = a.subrun and b.tel = 'M1')""",
    )
)
def missing_partner(spark, sf_dir):
    return fi.missing_partner(t.file_names(spark, sf_dir))


RUN_LISTS = """a as (select distinct run from base where value > 400),
 b as (select distinct run from base where value < 6)"""


def run_lists(spark, sf_dir):
    rows = t.base(spark, sf_dir)
    return rows.filter("value > 400").select("run"), rows.filter("value < 6").select("run")


@query(
    q.sql(
        q.BASE,
        RUN_LISTS,
        select="""select run, 'missing' as side from a where run not in (select run from b)
 union all select run, 'extra' from b where run not in (select run from a)""",
    )
)
def missing_runs(spark, sf_dir):
    return fi.missing_runs(*run_lists(spark, sf_dir))


@query(
    q.sql(
        q.BASE,
        RUN_LISTS,
        select="""select run, 'both' as part from a where run in (select run from b)
 union all select run, 'left_only' from a where run not in (select run from b)
 union all select run, 'right_only' from b where run not in (select run from a)
 union all select run, 'either' from (select run from a where run not in (select run from b)
  union all select run from b where run not in (select run from a))""",
    )
)
def run_sets(spark, sf_dir):
    return fi.run_sets(*run_lists(spark, sf_dir))


@query(
    select_sql(
        select="""select run, max(case when tel = 'M1' then n_kept end) as n_1,
 max(case when tel = 'M2' then n_kept end) as n_2, max(n_ref) as n_ref,
 max(case when tel = 'M1' then n_kept end) = max(case when tel = 'M2' then n_kept end)
  and abs(max(case when tel = 'M1' then n_kept end) - max(n_ref)) <= 1
  and abs(max(case when tel = 'M2' then n_kept end) - max(n_ref)) <= 1 as ok
 from walk_final group by run"""
    )
)
def count_mismatch(spark, sf_dir):
    return fi.count_mismatch(selected(spark, sf_dir).status)


BATCHED = """sized as (select name, tel, run, bytes, row_number() over (order by name) - 1 as i,
  count(*) over () as n, greatest(cast(floor(sum(bytes) over () / 1000000.0) as bigint), 1) as k from files),
 batched as (select name, tel, run, bytes, case when i < (n % k) * (n // k + 1) then i // (n // k + 1)
  else n % k + (i - (n % k) * (n // k + 1)) // greatest(n // k, 1) end as batch from sized)"""


@query(
    q.sql(*FILE_PARTS, BATCHED, select="select name, cast(bytes as bigint) as bytes, cast(batch as bigint) as batch from batched")
)
def batch_files(spark, sf_dir):
    files = t.file_names(spark, sf_dir).select("name", "bytes")
    return fi.batch_files(files, 1_000_000)


def stacked(spark, sf_dir):
    """Events with features and the name of their file; a list of batches that misses some files."""
    name = F.concat(F.lit("20240101_"), "tel", F.lit("_"), "run", F.lit("."), "subrun", F.lit("_Y_Src.csv"))
    rows = t.calib_events(spark, sf_dir).withColumn("name", name)
    return rows, fi.batch_files(t.file_names(spark, sf_dir), 1_000_000).filter("batch % 5 <> 3")


STACKED = """stacked as (select c.run, c.tel, c.seq, c.event_id, b.name, case when b.batch % 5 = 3 then -1
  else b.batch end as batch from calib c join batched b
  on b.name = '20240101_' || c.tel || '_' || c.run || '.' || c.subrun || '_Y_Src.csv')"""


@query(
    q.sql(
        *FILE_PARTS,
        BATCHED,
        STACKED,
        select="select run, tel, seq, cast(batch as bigint) as batch from stacked",
    )
)
def union_batches(spark, sf_dir):
    return fi.union_batches(*stacked(spark, sf_dir)).select("run", "tel", "seq", "batch")


@query(
    q.sql(
        *FILE_PARTS,
        BATCHED,
        STACKED,
        select="select name, count(*) as n_rows from stacked where batch = -1 group by name",
    )
)
def unlisted_files(spark, sf_dir):
    return fi.unlisted_files(*stacked(spark, sf_dir))


@query(
    q.sql(
        *FILE_PARTS,
        BATCHED,
        STACKED,
        select="""select name, count(*) * 64 as cells_before, count(*) * 64 as cells_after,
 true as ok from stacked group by name""",
    )
)
def size_conserved(spark, sf_dir):
    from duoscope.sources.shared import shared_folder

    path = shared_folder(spark, "batches")
    rows, batched = stacked(spark, sf_dir)
    fi.write_batches(fi.union_batches(rows, batched), path, 100_000)
    return fi.size_conserved(rows, spark.read.parquet(path))


@query(
    q.sql(
        q.BASE,
        """runs as (select run, row_number() over (order by run) as i, count(*) over () as n
 from (select distinct run from base))""",
        select="""select run, case when i <= cast(trunc(n * 0.6::double) as bigint) - 1 then 'train' else 'test' end as side
 from runs""",
    )
)
def train_test_split_runs(spark, sf_dir):
    return fi.train_test_split_runs(t.base(spark, sf_dir).select("run"))


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        """runs as (select run, row_number() over (order by run) as i, count(*) over () as n
 from (select distinct run from calib))""",
        select="""select c.run, tel, case when i <= cast(trunc(n * 0.6::double) as bigint) - 1 then 'train' else 'test' end as side,
 count(*) as n_rows from calib c join runs r on r.run = c.run group by all""",
    )
)
def split_events_by_run(spark, sf_dir):
    rows = t.calib(spark, sf_dir)
    sides = fi.train_test_split_runs(rows.select("run"))
    return fi.with_side(rows, sides).groupBy("run", "tel", "side").agg(F.count("*").alias("n_rows"))


STAGES = """shapes as (select 'calibrated' as stage, run, count(*) as n_rows, 64 as n_features from calib
  where tel = 'M1' group by run
 union all select 'filtered', run, count(*), 64 from walk_selected where tel = 'M1' group by run
 union all select 'joined', run, count(*), 128 from walk_selected where tel = 'M1' group by run)"""


def stages(spark, sf_dir):
    from duoscope.operators.stereo import attach_position, stereo_of_kept

    events = t.calib_events(spark, sf_dir)
    kept = selected(spark, sf_dir).kept
    return {
        "calibrated": t.telescope(events, "M1"),
        "filtered": attach_position(t.telescope(events, "M1"), kept),
        "joined": stereo_of_kept(events, kept),
    }


@query(
    select_sql(select="select stage, run, n_rows, cast(n_features as int) as n_features from shapes").replace(
        "\nselect stage", f",\n{STAGES}\nselect stage"
    )
)
def stage_shapes(spark, sf_dir):
    return stt.stage_shapes(stages(spark, sf_dir))


@query(
    select_sql(
        select="""select run, coalesce(max(case when stage = 'filtered' then n_rows end), 0) as n_filtered,
 coalesce(max(case when stage = 'joined' then n_rows end), 0) as n_joined,
 coalesce(max(case when stage = 'filtered' then n_rows end), 0)
  = coalesce(max(case when stage = 'joined' then n_rows end), 0) as ok from shapes group by run"""
    ).replace("\nselect run, coalesce", f",\n{STAGES}\nselect run, coalesce")
)
def stage_reconcile(spark, sf_dir):
    shapes = stt.stage_shapes(stages(spark, sf_dir))
    return stt.stage_reconcile(shapes, ["filtered", "joined"])
