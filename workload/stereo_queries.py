"""Joins of the telescopes and the checks around them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from duoscope.operators import stereo as st
from duoscope.sources import events as ev
from duoscope.sources.shared import listed, shared_folder, written
from workload import sql as q
from workload import tables as t
from workload.registry import query
from workload.selection_queries import SELECT, selected, select_sql
from workload.source_queries import digest

MINUTE = "cast(extract(hour from ts) * 60 + extract(minute from ts) as double)"


def longform(rows, *columns):
    """One row per feature, rounded to six digits."""
    return rows.select(*columns, F.posexplode("pix").alias("pos", "x")).withColumn(
        "x", F.round(F.col("x").cast("double"), 6)
    )


def keyed(spark, sf_dir, tel: str):
    """One telescope of ``calib`` with features; keys of M2 differ where the clocks disagree."""
    rows = t.telescope(t.calib_events(spark, sf_dir), tel)
    if tel == "M2":
        late = F.col("value") > 400
        rows = rows.withColumn("time2", F.when(late, F.col("time2") + 1).otherwise(F.col("time2")))
    return rows


STEREO_DIGEST = """stereo_digest as (
 select {columns}, round(2 * 0 + d1.s - d1.e0 + 1.0 + d2.s, 6) as pix_sum,
  round(2 * d1.m + 2 * d2.m + d2.s, 6) as pix_moment
 from {source} join digest d1 on d1.vec_id = {e1} % (select count(*) from embeddings)
 join digest d2 on d2.vec_id = ({e2} * 7 + 3) % (select count(*) from embeddings))"""


# Both telescopes must be free of repeated keys before they are joined.
KEYED = """sides as (select run, tel, nanotime, id, event_id,
  case when tel = 'M2' and value > 400 then time2 + 1 else time2 end as time2 from calib),
 repeats as (select run, nanotime, time2, id from sides group by run, tel, nanotime, time2, id having count(*) > 1),
 pairs as (select a.run, a.nanotime, a.time2, a.id, a.event_id as e1, b.event_id as e2
 from sides a join sides b on a.run = b.run and a.nanotime = b.nanotime and a.id = b.id and a.time2 = b.time2
 where a.tel = 'M1' and b.tel = 'M2'),
 key_state as (select c.run, n_1, n_2, coalesce(n_joined, 0) as n_joined, coalesce(n_repeated, 0) as n_repeated,
  case when n_repeated > 0 then 'repeated_keys' when n_1 = 0 or n_2 = 0 then 'missing_partner' else 'ok' end as status
  from (select run, count(*) filter (where tel = 'M1') as n_1, count(*) filter (where tel = 'M2') as n_2
   from sides group by run) c
  left join (select run, count(*) as n_joined from pairs group by run) j on j.run = c.run
  left join (select run, count(distinct (nanotime, time2, id)) as n_repeated from repeats group by run) r
   on r.run = c.run)"""

TIME_KEYS = ["nanotime", "time2", "id"]


@query(q.sql(q.BASE, q.CALIB, KEYED, select="select * from key_state"))
def stereo_key_status(spark, sf_dir):
    """Every run; few key values would multiply the events of some."""
    return st.key_status(keyed(spark, sf_dir, "M1"), keyed(spark, sf_dir, "M2"), TIME_KEYS)


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        KEYED,
        select="""select run, nanotime, time2, id, count(*) filter (where tel = 'M1') as n_1,
 count(*) filter (where tel = 'M2') as n_2 from sides group by run, nanotime, time2, id
 having count(*) filter (where tel = 'M1') > 1 or count(*) filter (where tel = 'M2') > 1""",
    )
)
def stereo_repeated_keys(spark, sf_dir):
    """The keys that hold up their runs."""
    return st.repeated_keys(keyed(spark, sf_dir, "M1"), keyed(spark, sf_dir, "M2"), TIME_KEYS)


@query(
    q.sql(
        q.FEATURES,
        q.BASE,
        q.CALIB,
        KEYED,
        """joined as (select * from pairs where (run, nanotime, time2, id) not in (from repeats))""",
        STEREO_DIGEST.format(
            columns="run, nanotime, time2, id, cast(e1 % 46 as double) as zd, cast(e1 % 360 as double) as az",
            source="joined",
            e1="e1",
            e2="e2",
        ),
        select="select * from stereo_digest",
    )
)
def stereo_join_unrepeated(spark, sf_dir):
    """Only events with repeated keys are held back, not their runs."""
    sides = keyed(spark, sf_dir, "M1"), keyed(spark, sf_dir, "M2")
    joined = st.stereo_join(*sides, "time", quarantine="keys").rows
    return joined.select("run", "nanotime", "time2", "id", "zd", "az", *digest()).drop("n_features")


@query(
    q.sql(
        q.FEATURES,
        q.BASE,
        q.CALIB,
        KEYED,
        """joined as (select * from pairs where run in (select run from key_state where status = 'ok'))""",
        STEREO_DIGEST.format(
            columns="run, nanotime, time2, id, cast(e1 % 46 as double) as zd, cast(e1 % 360 as double) as az",
            source="joined",
            e1="e1",
            e2="e2",
        ),
        select="select * from stereo_digest",
    )
)
def stereo_join_time(spark, sf_dir):
    joined = st.stereo_join(keyed(spark, sf_dir, "M1"), keyed(spark, sf_dir, "M2"), "time").rows
    return joined.select("run", "nanotime", "time2", "id", "zd", "az", *digest()).drop("n_features")


@query(
    q.sql(
        q.FEATURES,
        q.side(True),
        STEREO_DIGEST.format(
            columns="run, value as energy, event_id as id, zd, az", source="ev", e1="event_id", e2="event_id"
        ),
        select="select * from stereo_digest",
    )
)
def stereo_join_mc(spark, sf_dir):
    rows = t.paired(spark, sf_dir, True).withColumn("energy", F.col("value"))
    joined = st.stereo_join(t.telescope(rows, "M1"), t.telescope(rows, "M2"), "mc").rows
    return joined.select("run", "energy", "id", "zd", "az", *digest()).drop("n_features")


@query(
    q.sql(
        *SELECT,
        q.FEATURES,
        """both_sides as (select a.run, a.sseq, c.nanotime, c.time2, c.id, c.event_id as e1, d.event_id as e2
 from walk_selected a join walk_selected b on a.run = b.run and a.sseq = b.sseq and a.tel = 'M1' and b.tel = 'M2'
 join calib c on c.run = a.run and c.tel = 'M1' and c.seq = a.seq
 join calib d on d.run = b.run and d.tel = 'M2' and d.seq = b.seq)""",
        STEREO_DIGEST.format(
            columns="run, sseq, nanotime, time2, id, cast(e1 % 46 as double) as zd",
            source="both_sides",
            e1="e1",
            e2="e2",
        ),
        select="select * from stereo_digest",
        recursive=True,
    )
)
def stereo_join_selected(spark, sf_dir):
    """Selected events, joined on their position in the stereo list."""
    joined = st.stereo_of_kept(t.calib_events(spark, sf_dir), selected(spark, sf_dir).kept)
    return joined.select("run", "sseq", "nanotime", "time2", "id", "zd", *digest()).drop("n_features")


@query(
    q.sql(
        *SELECT,
        q.FEATURES,
        """both_sides as (select a.run, a.sseq, c.nanotime, c.time2, c.id, c.event_id as e1, d.event_id as e2
 from walk_selected a join walk_selected b on a.run = b.run and a.sseq = b.sseq and a.tel = 'M1' and b.tel = 'M2'
 join calib c on c.run = a.run and c.tel = 'M1' and c.seq = a.seq
 join calib d on d.run = b.run and d.tel = 'M2' and d.seq = b.seq)""",
        STEREO_DIGEST.format(
            columns="run, sseq, nanotime, time2, id, cast(e1 % 46 as double) as zd",
            source="both_sides",
            e1="e1",
            e2="e2",
        ),
        select="select * from stereo_digest",
        recursive=True,
    )
)
def stereo_join_bucketed(spark, sf_dir):
    """The same from a table bucketed by run, telescope and position: M1 features stay in place."""
    events = t.calib_events(spark, sf_dir)
    buckets = ev.write_event_buckets(
        events, f"buckets_{uuid.uuid4().hex}", path=shared_folder(spark, "buckets")
    )
    joined = st.stereo_of_kept(buckets, selected(spark, sf_dir).kept)
    return joined.select("run", "sseq", "nanotime", "time2", "id", "zd", *digest()).drop("n_features")


@query(
    q.sql(
        *SELECT,
        q.FEATURES,
        """both_sides as (select a.run, a.sseq, c.nanotime, c.time2, c.id, c.event_id as e1, d.event_id as e2
 from walk_selected a join walk_selected b on a.run = b.run and a.sseq = b.sseq and a.tel = 'M1' and b.tel = 'M2'
 join calib c on c.run = a.run and c.tel = 'M1' and c.seq = a.seq
 join calib d on d.run = b.run and d.tel = 'M2' and d.seq = b.seq)""",
        STEREO_DIGEST.format(
            columns="run, sseq, nanotime, time2, id, cast(e1 % 46 as double) as zd",
            source="both_sides",
            e1="e1",
            e2="e2",
        ),
        select="select * from stereo_digest",
        recursive=True,
    )
)
def stereo_join_positioned(spark, sf_dir):
    """The same from a selection written with its positions: no features move in the join."""
    table = st.write_selected(
        t.calib_events(spark, sf_dir),
        selected(spark, sf_dir).kept,
        f"selected_{uuid.uuid4().hex}",
        path=shared_folder(spark, "selected"),
    )
    joined = st.stereo_of_positions(table)
    return joined.select("run", "sseq", "nanotime", "time2", "id", "zd", *digest()).drop("n_features")


POSITIONED = """positioned as (
 select c.*, row_number() over (partition by run, tel order by seq) - 1 as pos
 from calib c where (event_id % 7 <> 0 and event_id % 11 <> 0) or user_id % 10 = 3),
 place_state as (select run, n_1, n_2, case when n_1 = 0 or n_2 = 0 then 'missing_partner'
   when n_1 <> n_2 then 'length_differs' else 'ok' end as status
  from (select run, count(*) filter (where tel = 'M1') as n_1, count(*) filter (where tel = 'M2') as n_2
   from positioned group by run)),
 both_sides as (select a.run, a.pos as sseq, {keys} as id, a.event_id as e1, b.event_id as e2
 from positioned a join positioned b on a.run = b.run and a.pos = b.pos and a.tel = 'M1' and b.tel = 'M2'
  and a.run in (select run from place_state where status = 'ok'))"""


def aligned(spark, sf_dir):
    """Events that both telescopes saw, but in some runs those that one of them saw."""
    both = (F.col("event_id") % 7 != 0) & (F.col("event_id") % 11 != 0)
    return t.calib_events(spark, sf_dir).filter(both | (F.col("user_id") % 10 == 3))


@query(
    q.sql(q.BASE, q.CALIB, POSITIONED.format(keys="a.id"), select="select run, n_1, n_2, status from place_state")
)
def stereo_position_status(spark, sf_dir):
    """Every run: whether its rows may be paired by position."""
    rows = aligned(spark, sf_dir)
    return st.position_status(rows, st.positions(rows)).select("run", "n_1", "n_2", "status")


@query(
    q.sql(
        q.FEATURES,
        q.BASE,
        q.CALIB,
        POSITIONED.format(keys="a.id"),
        STEREO_DIGEST.format(columns="run, sseq, id", source="both_sides", e1="e1", e2="e2"),
        select="select * from stereo_digest",
    )
)
def stereo_join_position(spark, sf_dir):
    rows = aligned(spark, sf_dir)
    placed = st.attach_position(rows, st.positions(rows))
    joined = st.stereo_join(t.telescope(placed, "M1"), t.telescope(placed, "M2"), "position").rows
    return joined.select("run", "sseq", "id", *digest()).drop("n_features")


@query(
    q.sql(
        q.FEATURES,
        q.BASE,
        q.CALIB,
        POSITIONED.format(keys="b.id"),
        STEREO_DIGEST.format(columns="run, sseq, id", source="both_sides", e1="e1", e2="e2"),
        select="select * from stereo_digest",
    )
)
def stereo_join_position_m2(spark, sf_dir):
    rows = aligned(spark, sf_dir)
    places = st.positions(rows)
    kept = st.accepted_rows(places, st.position_status(rows, places))
    joined = st.stereo_of_kept(rows, kept, "M2")
    return joined.select("run", "sseq", "id", *digest()).drop("n_features")


@query(
    q.sql(
        q.side(None),
        q.FEATURES,
        q.longform(),
        select=f"select {q.MC}, run, event_id, cast(pos as int) as pos, {q.r6('x')} as x from longform",
    )
)
def interleave(spark, sf_dir):
    return longform(t.all_stereo_rows(spark, sf_dir), "mc", "run", "event_id")


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        select="""select a.run, sum(case when b.n is null then 0 else b.n end)::bigint as n_both,
 count(*) filter (where b.n is null) as n_left_only
 from calib a left join (select run, id, count(*) as n from calib where tel = 'M2' group by run, id) b
  on b.run = a.run and b.id = a.id where a.tel = 'M1' group by a.run""",
    )
)
def pair_with_indicator(spark, sf_dir):
    rows = t.calib(spark, sf_dir)
    return st.pair_with_indicator(t.telescope(rows, "M1"), t.telescope(rows, "M2"))


@query(
    select_sql(
        select="""select run, max(case when tel = 'M1' then dup end) as tail_dup_1,
 max(case when tel = 'M2' then dup end) as tail_dup_2, min(dup) = max(dup) as agree
 from (select run, tel, count(*) = 2 and count(distinct seq) = 1 as dup
  from (select *, max(sseq) over (partition by run, tel) as mx from walk_selected)
  where sseq >= mx - 1 group by run, tel) group by run"""
    )
)
def tail_duplicate(spark, sf_dir):
    last = listed(st.last_rows(selected(spark, sf_dir).kept), "last-rows")
    rows = written(st.attach_position(t.calib_events(spark, sf_dir), last), "tails")
    return st.tail_duplicate(rows, ["nanotime", "time2", "id", "zd", "az", "pix"])


@query(
    """select lpad(cast(l_suppkey as varchar), 8, '0') as run, cast(sum(n) as bigint) as n_rows,
 cast(sum(n) - count(*) as bigint) as n_duplicates
 from (select l_suppkey, l_orderkey, l_linenumber, count(*) as n from lineitem
  group by l_suppkey, l_orderkey, l_linenumber) group by l_suppkey"""
)
def duplicate_count(spark, sf_dir):
    rows = t.table(spark, sf_dir, "lineitem").withColumn(
        "run", F.lpad(F.col("l_suppkey").cast("string"), 8, "0")
    )
    return st.duplicate_count(rows, ["l_orderkey", "l_linenumber"])


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        f"""pixrows as (select run, tel, {q.VEC} as vec, nanotime, time2, id from calib)""",
        select="""select run, cast(sum(n) as bigint) as n_rows, cast(sum(n) - count(*) as bigint) as n_duplicates
 from (select run, tel, vec, id, nanotime, time2, count(*) as n from pixrows
  group by run, tel, vec, id, nanotime, time2) group by run""",
    )
)
def duplicate_event_count(spark, sf_dir):
    """Whole event rows, features included."""
    rows = t.calib_events(spark, sf_dir)
    return st.duplicate_count(rows, ["tel", "nanotime", "time2", "id", "pix"])


GROWTH = """counts as (select run, count(*) filter (where tel = 'M1') as n_1,
  count(*) filter (where tel = 'M2') as n_2 from calib group by run),
 joined as (select a.run, count(*) as n_joined from calib a join calib b
  on a.run = b.run and a.nanotime = b.nanotime and a.time2 = b.time2 and a.id = b.id
  where a.tel = 'M1' and b.tel = 'M2' group by a.run)"""


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        GROWTH,
        select="""select c.run, n_1, n_2, coalesce(n_joined, 0) as n_joined,
 coalesce(n_joined, 0) <= greatest(n_1, n_2) as ok from counts c left join joined j on j.run = c.run""",
    )
)
def join_growth(spark, sf_dir):
    rows = t.calib(spark, sf_dir)
    m1, m2 = t.telescope(rows, "M1"), t.telescope(rows, "M2")
    joined = m1.join(m2.select("run", "nanotime", "time2", "id"), ["run", "nanotime", "time2", "id"])
    return st.join_growth(m1, m2, joined)


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        """counts as (select run, count(*) filter (where tel = 'M1') as n_1,
  count(*) filter (where tel = 'M2') as n_2 from calib group by run),
 joined as (select a.run, count(*) as n_joined from calib a join calib b
  on a.run = b.run and a.nanotime = b.nanotime and a.time2 = b.time2 and a.id = b.id
  where a.tel = 'M1' and b.tel = 'M2' group by a.run)""",
        select="""select c.run, n_1, n_2, coalesce(n_joined, 0) as n_joined,
 coalesce(n_joined, 0) <= greatest(n_1, n_2) as ok from counts c left join joined j on j.run = c.run""",
    )
)
def key_growth(spark, sf_dir):
    """All runs, also those whose repeated keys would multiply."""
    rows = t.calib(spark, sf_dir)
    return st.key_growth(t.telescope(rows, "M1"), t.telescope(rows, "M2"), ["nanotime", "time2", "id"])


@query(
    q.sql(
        q.BASE,
        q.CALIB,
        select="""select run, cast(max(case when tel = 'M1' then 64 end) as int) as width_1,
 cast(max(case when tel = 'M2' then case when user_id % 10 = 3 then 63 else 64 end end) as int) as width_2,
 min(case when tel = 'M2' and user_id % 10 = 3 then 63 else 64 end)
  = max(case when tel = 'M2' and user_id % 10 = 3 then 63 else 64 end) as ok from calib group by run""",
    )
)
def width_mismatch(spark, sf_dir):
    short = (F.col("tel") == "M2") & (F.col("user_id") % 10 == 3)
    rows = t.calib_events(spark, sf_dir).withColumn(
        "pix", F.when(short, F.slice("pix", 1, 63)).otherwise(F.col("pix"))
    )
    return st.width_mismatch(rows)
