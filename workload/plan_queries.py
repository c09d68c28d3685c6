"""Whole preparations, from calibrated events to energies."""

from __future__ import annotations

from pyspark.sql import functions as F

from duoscope.operators.matching import MC_KEYS
from duoscope.operators.ordering import block_of, number_rows
from duoscope.plans.preprocess import preprocess
from duoscope.plans.resume import Preparation
from duoscope.sources.shared import shared_folder, written
from workload import sql as q
from workload import tables as t
from workload.energy_queries import mean_of_features
from workload.norm_queries import mc_norm
from workload.registry import query
from workload.selection_queries import SELECT
from workload.stereo_queries import longform

DATA_LONG = f"""joined as (
 select a.run, a.sseq, c.nanotime, c.time2, c.id, c.event_id as e1, d.event_id as e2
 from walk_selected a join walk_selected b on a.run = b.run and a.sseq = b.sseq and a.tel = 'M1' and b.tel = 'M2'
 join calib c on c.run = a.run and c.tel = 'M1' and c.seq = a.seq
 join calib d on d.run = b.run and d.tel = 'M2' and d.seq = b.seq),
 jlong as (
 select run, sseq, 2 * p as pos, case when p = 0 then 1.0 else x end as x from joined join feats on vec_id = e1 % {q.N_VEC}
 union all
 select run, sseq, 2 * p + 1, x from joined join feats on vec_id = (e2 * 7 + 3) % {q.N_VEC}),
 jz as (select l.run, l.sseq, l.pos,
  cast(cast(case when n.std = 0 then l.x else (l.x - n.mean) / n.std end as float) as double) as x
 from jlong l join norm n on n.pos = l.pos + 1)"""

NORM = (
    q.side(True),
    q.FEATURES,
    q.longform(),
    q.stats("ev", "longform", True, "norm"),
)


def prepared(spark, sf_dir, **options):
    return preprocess(
        "data",
        t.calib_events(spark, sf_dir),
        t.stereo_keys(spark, sf_dir),
        t.valid_subruns(spark, sf_dir),
        norm=mc_norm(spark, sf_dir),
        stored=True,
        **options,
    )


@query(
    q.sql(
        *SELECT,
        *NORM,
        DATA_LONG,
        select=f"""select run, count(distinct sseq) as n_events,
 {q.r6("avg(case when pos % 4 < 2 then x end)")} as mean_charge from jz group by run""",
        recursive=True,
    )
)
def surviving_events(spark, sf_dir):
    """Events per run that survive in both telescopes, and their mean normalised charge."""
    rows = prepared(spark, sf_dir).normalized
    charges = F.filter("pix", lambda x, i: i % 4 < 2).cast("array<double>")
    total = F.aggregate(charges, F.lit(0.0), lambda a, x: a + x)
    return rows.groupBy("run").agg(
        F.count("*").alias("n_events"),
        F.round(F.sum(total) / F.sum(F.size(charges)), 6).alias("mean_charge"),
    )


@query(
    q.sql(
        *SELECT,
        *NORM,
        DATA_LONG,
        q.SCALE,
        select=f"""select j.run, j.sseq, j.nanotime, j.time2, j.id, {q.r6("exp(z.m * s.std + s.mean)")} as dl
 from joined j join (select run, sseq, avg(x) as m from jz group by run, sseq) z on z.run = j.run and z.sseq = j.sseq,
 scale s""",
        recursive=True,
    )
)
def preprocess_data(spark, sf_dir):
    """Selection, join, normalisation, scores and energies of observed events."""
    done = prepared(spark, sf_dir, make_predict_fn=mean_of_features(), n_features=2 * t.N_FEATURES)
    return done.energies.select(
        "run", "sseq", "nanotime", "time2", "id", F.round("dl", 6).alias("dl")
    )


@query(
    q.sql(
        *SELECT,
        *NORM,
        DATA_LONG,
        q.SCALE,
        select=f"""select j.run, j.sseq, j.nanotime, j.time2, j.id, {q.r6("exp(z.m * s.std + s.mean)")} as dl
 from joined j join (select run, sseq, avg(x) as m from jz group by run, sseq) z on z.run = j.run and z.sseq = j.sseq,
 scale s""",
        recursive=True,
    )
)
def resumed_preparation(spark, sf_dir):
    """The same in stages on disk: stopped before scaling, then gone on with."""
    prep = Preparation(spark, shared_folder(spark, "resumed"))
    given = {
        "stereo_keys": t.stereo_keys(spark, sf_dir),
        "norm": written(mc_norm(spark, sf_dir), "norm"),
        "events": t.calib_events(spark, sf_dir),
        "valid": t.valid_subruns(spark, sf_dir),
        "make_predict_fn": mean_of_features(),
        "n_features": 2 * t.N_FEATURES,
    }
    prep.run(**given, until="stereo")
    rows = prep.run(**given).table("energies")
    return rows.select("run", "sseq", "nanotime", "time2", "id", F.round("dl", 6).alias("dl"))


def mc_events(spark, sf_dir):
    """Simulated rows of both telescopes with positions, and their stereo list."""
    rows = t.paired(spark, sf_dir, True).withColumn("energy", F.col("value"))
    m1 = t.telescope(rows, "M1").select("run", *MC_KEYS, "seq")
    both = number_rows(m1, ["run"], [block_of("seq")], ["seq"], "sseq")
    tels = F.explode(F.array(F.lit("M1"), F.lit("M2"))).alias("tel")
    return rows, both.select("run", "sseq", tels, *MC_KEYS)


MC_Z = f"""z as (select l.run, l.event_id, avg(cast(cast(case when n.std = 0 then l.x
   else (l.x - n.mean) / n.std end as float) as double)) as m
 from longform l join norm n on n.pos = l.pos + 1 group by l.run, l.event_id)"""


@query(
    q.sql(
        *NORM,
        MC_Z,
        q.SCALE,
        select=f"""select e.run, row_number() over (partition by e.run order by e.event_id) - 1 as sseq,
 {q.r6('value')} as mc_truth, {q.r6('exp(z.m * s.std + s.mean)')} as dl
 from ev e join z on z.run = e.run and z.event_id = e.event_id, scale s""",
    )
)
def preprocess_mc(spark, sf_dir):
    """Simulated events; the norm is built on the way."""
    rows, keys = mc_events(spark, sf_dir)
    done = preprocess(
        "mc", rows, keys, make_predict_fn=mean_of_features(), n_features=2 * t.N_FEATURES
    )
    return done.energies.select(
        "run", "sseq", F.round("mc_truth", 6).alias("mc_truth"), F.round("dl", 6).alias("dl")
    )


@query(
    q.sql(
        *NORM,
        f"""camera as (select (pos - 1) % 4 as channel, sum(mean) / {t.N_REAL} as mean, sum(std) / {t.N_REAL} as std
  from norm where pos between 1 and 128 group by 1),
 cz as (select l.run, l.event_id, l.pos, cast(cast(case when n.std = 0 then l.x else (l.x - c.mean) / c.std end
   as float) as double) as x
  from longform l join norm n on n.pos = l.pos + 1 join camera c on c.channel = l.pos % 4)""",
        select=f"""select c.run, p.sseq, cast(pos as int) as pos, {q.r6('x')} as x from cz c join (
  select run, event_id, row_number() over (partition by run order by event_id) - 1 as sseq from ev) p
  on p.run = c.run and p.event_id = c.event_id""",
    )
)
def preprocess_mc_camera(spark, sf_dir):
    """Events selected already are paired by position; camera-wise scaling."""
    rows = t.paired(spark, sf_dir, True).withColumn("energy", F.col("value"))
    done = preprocess("mc", rows, normalize="camerawise", n_real=t.N_REAL)
    return longform(done.normalized, "run", "sseq")
