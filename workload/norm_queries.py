"""Statistics and normalisation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope.functions import arrays
from duoscope.operators import moments as mo
from duoscope.operators import normalise as no
from duoscope.operators import statistics as stt
from duoscope.sources.shared import shared_folder
from workload import sql as q
from workload import tables as t
from workload.registry import query
from workload.stereo_queries import longform

MC = (q.side(True), q.FEATURES, q.longform())
MC_NORM = (*MC, q.stats("ev", "longform", True, "norm"))
DATA = (
    q.side(True, "mc_ev"),
    q.side(False),
    q.FEATURES,
    q.longform("mc_ev", "mc_longform"),
    q.longform(),
    q.stats("mc_ev", "mc_longform", True, "norm"),
)
NORM_SELECT = f"select cast(pos as int) as pos, {q.r6('mean')} as mean, {q.r6('std')} as std from "


def rounded(norm):
    return norm.select(
        *[c for c in norm.columns if c not in ("mean", "std")],
        F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"),
    )


def mc_norm(spark, sf_dir):
    return stt.feature_stats(t.stereo_rows(spark, sf_dir, True), mc=True)


@query(q.sql(*MC_NORM, select=NORM_SELECT + "norm"))
def feature_stats(spark, sf_dir):
    return rounded(mc_norm(spark, sf_dir))


@query(
    q.sql(
        q.side(False),
        q.FEATURES,
        q.longform(),
        q.stats("ev", "longform", False, "norm"),
        select=NORM_SELECT + "norm",
    )
)
def data_feature_stats(spark, sf_dir):
    return rounded(stt.feature_stats(t.stereo_rows(spark, sf_dir, False), mc=False))


def stored_moments(spark, sf_dir):
    """States of the simulated runs, added to the table in three steps."""
    rows, path = t.stereo_rows(spark, sf_dir, True), shared_folder(spark, "run-moments")
    for step in range(3):
        states = mo.add_runs(rows.filter(F.col("run").cast("int") % 3 == step), path, mc=True)
    return states


@query(q.sql(*MC_NORM, select=NORM_SELECT + "norm"))
def moments_norm(spark, sf_dir):
    """The norm of all runs from their stored states."""
    return rounded(mo.norm_of(stored_moments(spark, sf_dir)))


@query(
    q.sql(
        *MC,
        "run_ev as (select * from ev)",
        q.stats("run_ev", "longform", True, "run_norm", "run"),
        select=NORM_SELECT + "(select pos, avg(mean) as mean, avg(std) as std from run_norm group by pos)",
    )
)
def moments_mean_of_runs(spark, sf_dir):
    """The mean over runs of their own means and deviations, from stored states."""
    return rounded(mo.mean_of_runs(stored_moments(spark, sf_dir), mc=True))


@query(f"select event_id, {q.r6('ln(value)')} as log_energy from events")
def log_energy(spark, sf_dir):
    rows = t.table(spark, sf_dir, "events")
    return rows.select("event_id", F.round(arrays.log_energy(F.col("value")), 6).alias("log_energy"))


@query(
    q.sql(
        q.side(True),
        q.FEATURES,
        q.longform(),
        q.stats("ev", "longform", True, "per_file", by="run"),
        select=f"select cast(pos as int) as pos, {q.r6('avg(mean)')} as mean, {q.r6('avg(std)')} as std from per_file group by pos",
    )
)
def mean_of_file_stats(spark, sf_dir):
    return rounded(stt.mean_of_file_stats(t.stereo_rows(spark, sf_dir, True), mc=True))


@query(
    q.sql(
        *DATA,
        q.stats("ev", "longform", False, "per_file", by="run"),
        select=f"""select cast(pos + 1 as int) as pos, {q.r6('avg(mean)')} as mean, {q.r6('avg(std)')} as std
 from per_file group by pos
 union all select cast(pos as int), {q.r6('mean')}, {q.r6('std')} from norm where pos = 0""",
    )
)
def with_mc_energy(spark, sf_dir):
    data = t.stereo_rows(spark, sf_dir, False)
    return rounded(stt.mean_of_file_stats(data, mc=False, mc_norm=t.energy_norm(spark, sf_dir)))


CAMERA = f"""camera as (select (pos - 1) % 4 as channel, sum(mean) / {t.N_REAL} as mean,
  sum(std) / {t.N_REAL} as std from norm where pos between 1 and 128 group by 1)"""


@query(
    q.sql(
        *MC_NORM,
        CAMERA,
        select=f"select cast(channel as int) as channel, {q.r6('mean')} as mean, {q.r6('std')} as std from camera",
    )
)
def camera_stats(spark, sf_dir):
    norm = mc_norm(spark, sf_dir)
    return rounded(stt.camera_stats(norm, 2 * t.N_FEATURES, t.N_REAL))


@query(
    q.sql(
        q.side(None),
        q.FEATURES,
        q.longform(),
        select=f"""select {q.MC}, run, cast(count(*) filter (where x > 0.2) as bigint) as n_nan, count(*) as n_values
 from longform group by run""",
    )
)
def nan_report(spark, sf_dir):
    """Features above a threshold stand for broken ones."""
    rows = t.all_stereo_rows(spark, sf_dir)
    nan = F.lit(float("nan")).cast("float")
    broken = rows.withColumn("pix", F.transform("pix", lambda x: F.when(x > 0.2, nan).otherwise(x)))
    return stt.nan_report(broken, ("mc", "run"))


Z = """z as (select l.run, l.event_id, l.pos,
  cast(cast(case when n.std = 0 then l.x else (l.x - n.mean) / n.std end as float) as double) as x
 from longform l join norm n on n.pos = l.pos + 1)"""
Z_SELECT = f"select run, event_id, cast(pos as int) as pos, {q.r6('x')} as x from z"


@query(q.sql(*DATA, Z, select=Z_SELECT))
def normalize_pixels(spark, sf_dir):
    """Observed events with the norm of simulated ones; position 0 has std 0."""
    rows = t.stereo_rows(spark, sf_dir, False)
    return longform(no.normalize_pixels(rows, mc_norm(spark, sf_dir), mc=False), "run", "event_id")


@query(
    q.sql(
        *DATA,
        Z.replace("as x\n", "as x, l.x as raw\n"),
        select=f"""select run, event_id, cast(pos as int) as pos, {q.r6('case when pos >= 125 then raw else x end')} as x
 from z""",
    )
)
def normalize_pixels_skip_tail(spark, sf_dir):
    rows = t.stereo_rows(spark, sf_dir, False)
    norm = mc_norm(spark, sf_dir)
    return longform(no.normalize_pixels(rows, norm, mc=False, skip_tail=3), "run", "event_id")


@query(
    q.sql(
        q.side(None),
        select=f"""select {q.MC}, run, event_id, {q.r6('(zd - 45) / 26')} as zd, {q.r6('(az - 180) / 105')} as az from ev""",
    )
)
def normalize_pointing(spark, sf_dir):
    rows = no.normalize_pointing(t.all_stereo_rows(spark, sf_dir))
    return rows.select("mc", "run", "event_id", F.round("zd", 6).alias("zd"), F.round("az", 6).alias("az"))


@query(
    q.sql(
        q.side(None),
        q.FEATURES,
        q.longform(),
        select=f"""select {q.MC}, run, event_id, cast(pos as int) as pos,
 {q.r6("case when x > 0.25 then 0 when x > 0.2 then 65504 when x < -0.2 then -65504 else x end")} as x from longform""",
    )
)
def finite(spark, sf_dir):
    """NaN and infinities put in place of large features."""

    def spoil(x):
        value = (
            F.when(x > 0.25, F.lit(float("nan")))
            .when(x > 0.2, F.lit(float("inf")))
            .when(x < -0.2, F.lit(float("-inf")))
            .otherwise(x)
        )
        return value.cast("float")

    rows = t.all_stereo_rows(spark, sf_dir).withColumn("pix", F.transform("pix", spoil))
    return longform(rows.withColumn("pix", arrays.finite_array("pix")), "mc", "run", "event_id")


CAMERA_Z = f"""z as (select l.run, l.event_id, l.pos,
  cast(cast(case when n.std = 0 then l.x else (l.x - c.mean) / c.std end as float) as double) as x
 from longform l join norm n on n.pos = l.pos + 1 join camera c on c.channel = {{channel}})"""


@query(q.sql(*MC_NORM, CAMERA, CAMERA_Z.format(channel="l.pos % 4"), select=Z_SELECT))
def normalize_camera(spark, sf_dir):
    rows = t.stereo_rows(spark, sf_dir, True)
    return longform(no.normalize_camera(rows, n_real=t.N_REAL), "run", "event_id")


@query(q.sql(*MC_NORM, CAMERA, CAMERA_Z.format(channel="0"), select=Z_SELECT))
def normalize_camera_compat(spark, sf_dir):
    rows = t.stereo_rows(spark, sf_dir, True)
    return longform(no.normalize_camera(rows, n_real=t.N_REAL, compat=True), "run", "event_id")


def own(pos: int, column: str) -> str:
    return f"({column} - (select mean from norm where pos = {pos})) / (select std from norm where pos = {pos})"


@query(
    q.sql(
        *MC_NORM,
        select=f"""select run, event_id, {q.r6(own(0, 'ln(value)'))} as energy, {q.r6(own(129, 'zd'))} as zd,
 {q.r6(own(130, 'az'))} as az from ev""",
    )
)
def normalize_camera_scalars(spark, sf_dir):
    rows = no.normalize_camera(t.stereo_rows(spark, sf_dir, True), n_real=t.N_REAL)
    return rows.select(
        "run", "event_id", *[F.round(c, 6).alias(c) for c in ("energy", "zd", "az")]
    )


@query(q.sql(*MC_NORM, Z, select=Z_SELECT))
def normalize_own(spark, sf_dir):
    return longform(no.normalize_own(t.stereo_rows(spark, sf_dir, True)), "run", "event_id")


@query(
    q.sql(
        *MC_NORM,
        select=f"select run, event_id, {q.r6(own(0, 'ln(value)'))} as energy, zd, az from ev",
    )
)
def normalize_own_scalars(spark, sf_dir):
    rows = no.normalize_own(t.stereo_rows(spark, sf_dir, True))
    return rows.select("run", "event_id", F.round("energy", 6).alias("energy"), "zd", "az")


@query(
    q.sql(
        q.FEATURES,
        select="""select vec_id, cast(p as int) as pos, round(cast(cast(x * 3 as float) as double), 6) + 0.0 as x
 from feats""",
    )
)
def narrowed(spark, sf_dir):
    """Double features to 32 bits."""
    from duoscope.sources.events import narrowed as narrow

    rows = t.table(spark, sf_dir, "embeddings")
    wide = rows.select(
        "vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda x: x * 3).alias("pix")
    )
    return longform(narrow(wide), "vec_id")


@query(
    """select mc, tel, n_rows, n_rows // 4 as n_sampled, n_rows // 4 as n_distinct,
 cast(0 as bigint) as n_foreign, cast(0 as bigint) as n_changed
 from (select user_id % 2 = 0 as mc, tel, count(*) as n_rows from events, (values ('M1'), ('M2')) t(tel)
  group by all)"""
)
def sample_exact(spark, sf_dir):
    """A quarter of each telescope's simulated and observed events: how many rows and keys
    were drawn, how many of them the input lacks, how many a second draw does not have."""
    parts = []
    for mc in (True, False):
        rows = t.paired(spark, sf_dir, mc)
        for tel in ("M1", "M2"):
            events = t.telescope(rows, tel).select("run", "id", "value")
            n = events.count() // 4
            keys = ("run", "id")
            first = stt.sample_exact(events, n, seed=7, keys=keys)
            second = stt.sample_exact(events, n, seed=7, keys=keys)
            lists = [
                events.select(*keys, F.lit(0).alias("list")),
                first.select(*keys, F.lit(1).alias("list")),
                second.select(*keys, F.lit(2).alias("list")),
            ]
            per_key = (
                lists[0].unionByName(lists[1]).unionByName(lists[2])
                .groupBy(*keys)
                .agg(*[F.count_if(F.col("list") == k).alias(f"in_{k}") for k in range(3)])
            )
            parts.append(
                per_key.agg(
                    F.sum("in_0").alias("n_rows"),
                    F.sum("in_1").alias("n_sampled"),
                    F.count_if(F.col("in_1") > 0).alias("n_distinct"),
                    F.count_if((F.col("in_1") > 0) & (F.col("in_0") == 0)).alias("n_foreign"),
                    F.count_if(F.col("in_1") != F.col("in_2")).alias("n_changed"),
                ).select(F.lit(mc).alias("mc"), F.lit(tel).alias("tel"), "*")
            )
    return reduce(DataFrame.unionByName, parts)
