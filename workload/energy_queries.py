"""Model scores to energies."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from duoscope.operators import energy as en
from duoscope.plans.energies import energies as energies_of
from duoscope.sources.shared import shared_folder
from workload import sql as q
from workload import tables as t
from workload.norm_queries import mc_norm
from workload.registry import query
from workload.source_queries import PREDICTED, prediction_files

PRED = (q.SCALE, PREDICTED)


def mean_of_features():
    """A stand-in for a trained model: the mean of the features.

    Nested, so that workers need not import this module.
    """

    def make_predict_fn():
        def predict(pix: np.ndarray) -> np.ndarray:
            return pix.astype("f8").mean(axis=1)

        return predict

    return make_predict_fn


@query(q.sql(q.SCALE, select=f"select {q.r6('mean')} as mean, {q.r6('std')} as std from scale"))
def energy_scale(spark, sf_dir):
    scale = en.energy_scale(mc_norm(spark, sf_dir))
    return scale.select(F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(q.sql(*PRED, select=f"select run, seq, id, {q.r6('value')} as dl from pred where not mc"))
def adjust_energy(spark, sf_dir):
    rows = en.adjust_energy(t.predictions(spark, sf_dir), t.energy_norm(spark, sf_dir))
    return rows.select("run", "seq", "id", F.round("dl", 6).alias("dl"))


@query(
    q.sql(
        *PRED,
        select=f"select run, seq, {q.r6('value')} as dl, {q.r6('value * exp(0.5 * std)')} as mc_truth from pred where mc",
    )
)
def adjust_mc_energy(spark, sf_dir):
    rows = en.adjust_energy(t.predictions(spark, sf_dir, True), t.energy_norm(spark, sf_dir))
    return rows.select(
        "run", "seq", F.round("dl", 6).alias("dl"), F.round("mc_truth", 6).alias("mc_truth")
    )


@query(q.sql(*PRED, select=f"select run, seq, {q.r6('value')} as dl from pred"))
def adjust_many(spark, sf_dir):
    """Observed and simulated scores in one table."""
    both = [
        t.predictions(spark, sf_dir).select("run", "seq", "dl"),
        t.predictions(spark, sf_dir, True).select("run", "seq", "dl"),
    ]
    rows = en.adjust_many(both, t.energy_norm(spark, sf_dir))
    return rows.select("run", "seq", F.round("dl", 6).alias("dl"))


@query(
    q.sql(
        *PRED,
        select="""select mc, run, seq, case when value > 400 then 0.0 else round(value, 6) end as dl
 from pred""",
    )
)
def impute_value(spark, sf_dir):
    """Scores that overflow the exponential become 0 in the imputation column."""
    from duoscope.sources.tables import impute_value as imputed

    sides = [t.predictions(spark, sf_dir, mc).withColumn("mc", F.lit(mc)) for mc in (True, False)]
    rows = sides[0].unionByName(sides[1], allowMissingColumns=True).drop("mc_truth").withColumn(
        "dl", F.when(F.col("nanotime") > 400, 1e6).otherwise(F.col("dl"))
    )
    adjusted = en.adjust_energy(rows, t.energy_norm(spark, sf_dir))
    return adjusted.select("mc", "run", "seq", F.round(imputed(F.col("dl")), 6).alias("dl"))


@query(
    q.sql(
        q.side(None),
        q.FEATURES,
        q.longform(),
        select=f"select {q.MC}, run, event_id, {q.r6('avg(x)')} as dl from longform group by run, event_id",
    )
)
def score(spark, sf_dir):
    rows = en.score(t.all_stereo_rows(spark, sf_dir), mean_of_features(), 2 * t.N_FEATURES)
    return rows.select("mc", "run", "event_id", F.round("dl", 6).alias("dl"))


@query(
    q.sql(
        *PRED,
        select=f"""select run, seq, id, nanotime,
 case when value > 20 and id % 19 <> 0 then {q.r6('value')} end as energy_est from pred where not mc""",
    )
)
def impute_energy(spark, sf_dir):
    """Estimates by event keys; some events have none, some keys two."""
    joined = imputed(spark, sf_dir).rows
    return joined.select("run", "seq", "id", "nanotime", F.round("energy_est", 6).alias("energy_est"))


def imputed(spark, sf_dir):
    energies = en.adjust_energy(t.predictions(spark, sf_dir), t.energy_norm(spark, sf_dir))
    known = energies.filter("nanotime > 20")
    known = known.unionByName(known.filter("id % 19 = 0").withColumn("dl", F.col("dl") + 1))
    return en.impute_energy(t.predictions(spark, sf_dir).drop("dl"), known)


@query(
    q.sql(
        *PRED,
        select="""select run, count(*) as n_events, count(*) filter (where value <= 20) as n_missing,
 count(*) filter (where value > 20 and id % 19 = 0) as n_repeated,
 bool_and(value > 20 and id % 19 <> 0) as ok from pred where not mc group by run""",
    )
)
def impute_energy_status(spark, sf_dir):
    """Per run: events without an estimate, and events whose keys have two."""
    return imputed(spark, sf_dir).status


@query(
    q.sql(
        *PRED,
        select=f"""select run, seq, {q.r6('value')} as energy_est from pred where not mc""",
    )
)
def impute_energy_by_position(spark, sf_dir):
    energies = en.adjust_energy(t.predictions(spark, sf_dir), t.energy_norm(spark, sf_dir))
    events = t.predictions(spark, sf_dir).select("run", "seq")
    joined = en.impute_energy(events, energies, on=("run", "seq")).rows
    return joined.select("run", "seq", F.round("energy_est", 6).alias("energy_est"))


@query(
    """select lpad(cast(user_id as varchar), 8, '0') as run, count(*) filter (where a and b) as n_rows,
 count(*) filter (where a and not b) as n_only_imputed, count(*) filter (where b and not a) as n_only_original,
 round(max(case when a and b then d end), 6) as max_diff, count(*) filter (where a and b and d >= 0.015) as n_above,
 bool_and(case when a and b then d < 0.015 else b end) as close, bool_and(case when a and b then d = 0 else b end) as exact
 from (select user_id, event_id % 13 <> 0 as a, event_id % 97 <> 0 as b,
  abs((value + case when user_id % 5 = 0 then 0.0 when event_id % 50 = 0 then 0.02 else 0.001 end) - value) as d from events)
 where a or b group by user_id"""
)
def energy_diff(spark, sf_dir):
    events = t.table(spark, sf_dir, "events").select(
        F.lpad(F.col("user_id").cast("string"), 8, "0").alias("run"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("dl"),
    )
    same = F.col("run").cast("long") % 5 == 0
    shift = F.when(same, 0.0).when(F.col("seq") % 50 == 0, 0.02).otherwise(0.001)
    imputed = events.filter("seq % 13 <> 0").withColumn("dl", F.col("dl") + shift)
    found = en.energy_diff(imputed, events.filter("seq % 97 <> 0"))
    return found.withColumn("max_diff", F.round("max_diff", 6))


@query(
    q.sql(
        *PRED,
        select=f"""select run, row_number() over (partition by run order by seq) - 1 as seq, id,
 {q.r6('value')} as dl, count(*) over (partition by run) as n_lines from pred where not mc""",
    )
)
def energies(spark, sf_dir):
    """Prediction files to adjusted energies, in file order, and the lines written for each run."""
    out = shared_folder(spark, "energies")
    rows = energies_of(
        spark, prediction_files(spark, sf_dir, False), t.energy_norm(spark, sf_dir), "data", out
    )
    lines = spark.read.text(f"{out}/impute")
    kept = lines.groupBy("run").agg(F.count("*").alias("n_lines"))
    return rows.join(kept, "run", "left").select(
        "run", "seq", "id", F.round("dl", 6).alias("dl"), "n_lines"
    )


@query(
    q.sql(
        *PRED,
        select="""select 'normalized_GA_za05to35_8_' || run || '_Y_wr' || kind as file, count(*) as n_lines
 from pred, (values ('_adjusted_impute.txt'), ('_adjusted_validate.txt')) k(kind) where mc group by all""",
    )
)
def energy_files(spark, sf_dir):
    """Outputs by prediction file, under their names, and the lines of each."""
    out = shared_folder(spark, "energy-files")
    energies_of(spark, prediction_files(spark, sf_dir, True), t.energy_norm(spark, sf_dir), "mc", out, by="name")
    impute = spark.read.text(f"{out}/impute")
    validate = spark.read.option("header", "true").schema("MCTruth string, DL string, file string").csv(f"{out}/validate")
    return impute.select("file").unionByName(validate.select("file")).groupBy("file").agg(F.count("*").alias("n_lines"))
