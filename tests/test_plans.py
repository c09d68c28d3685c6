"""Shapes of physical plans: what is pushed down, broadcast and shuffled."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from duoscope.operators import normalise as no
from duoscope.operators import statistics as stt
from duoscope.operators import stereo as st
from duoscope.plans.preprocess import preprocess, resolve_norm
from duoscope.sources import events as ev
from duoscope.sources.shared import listed, shared_folder, written

WIDTH = 8


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    rows = spark.range(400).select(
        F.concat(F.lit("r"), (F.col("id") % 4).cast("string")).alias("run"),
        F.when(F.col("id") % 8 < 4, "M1").otherwise("M2").alias("tel"),
        F.floor(F.col("id") / 8).cast("long").alias("seq"),
        F.floor(F.col("id") / 8).cast("double").alias("nanotime"),
        F.lit(1.0).alias("time2"),
        F.floor(F.col("id") / 8).cast("long").alias("id"),
        F.lit(20.0).alias("zd"),
        F.lit(90.0).alias("az"),
        F.transform(
            F.sequence(F.lit(1), F.lit(WIDTH)), lambda i: (i + F.col("id")).cast("float")
        ).alias("pix"),
    )
    return written(rows, "plan-events")


@pytest.fixture(scope="module")
def kept(events):
    return written(events.filter("seq % 5 != 0").select("run", "tel", "seq", (F.col("seq") * 1).alias("sseq")), "plan-kept")


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def feature_exchanges(plan):
    """Shuffles whose input carries a feature column."""
    count = 0
    lines = plan.splitlines()
    for number, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            depth = len(re.match(r"[\s:|+*\-]*", line).group())
            below = []
            for other in lines[number + 1 :]:
                if len(re.match(r"[\s:|+*\-]*", other).group()) <= depth:
                    break
                below.append(other)
            first = next((x for x in below if "Project" in x or "Scan" in x), "")
            count += "pix" in first
    return count


def test_key_scan_reads_only_keys(events):
    plan = plan_of(ev.key_columns(events))
    assert "ReadSchema" in plan
    assert "pix" not in plan


def test_list_joins_are_broadcast(events):
    runs = listed(events.select("run").distinct().filter("run != 'r0'"), "plan-runs")
    plan = plan_of(events.join(runs, "run", "left_semi"))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_selected_events_move_three_times_at_most(events, kept, no_broadcast):
    plan = plan_of(st.stereo_of_kept(events, kept))
    assert feature_exchanges(plan) == 3


def test_bucketed_events_move_once(spark, events, kept, no_broadcast):
    table = ev.write_event_buckets(events, "plan_buckets", 4)
    joined = st.stereo_of_kept(table, kept)
    assert feature_exchanges(plan_of(joined)) == 1
    plain = st.stereo_of_kept(events, kept)
    key = ["run", "sseq"]
    assert joined.orderBy(key).collect() == plain.orderBy(key).collect()


def test_positioned_buckets_leave_all_features_in_place(spark, events, kept, no_broadcast):
    """Positions are assigned when the selection is written; its stereo joins shuffle nothing."""
    table = st.write_selected(events, kept, "plan_selected", 4)
    for owner in ("M1", "M2"):
        joined = st.stereo_of_positions(table, owner)
        plan = plan_of(joined)
        assert feature_exchanges(plan) == 0 and "Exchange" not in plan
        plain = st.stereo_of_kept(events, kept, owner)
        key = ["run", "sseq"]
        assert joined.orderBy(key).collect() == plain.orderBy(key).collect()
    assert feature_exchanges(plan_of(st.stereo_of_positions(st.attach_position(events, kept)))) > 0


def test_buckets_grow_with_the_table(spark, events, kept, no_broadcast, monkeypatch):
    """A bucket is one task's work: without a given number their rows are bounded."""
    monkeypatch.setattr(ev, "BUCKET_ROWS", 10)
    n = kept.count()
    table = st.write_selected(events, kept, "plan_counted")
    said = {r.col_name: r.data_type for r in spark.sql("describe extended plan_counted").collect()}
    assert int(said["Num Buckets"]) == max(ev.MIN_BUCKETS, -(-n // 10)) > ev.MIN_BUCKETS
    plan = plan_of(st.stereo_of_positions(table))
    assert feature_exchanges(plan) == 0 and "Exchange" not in plan
    assert ev.bucket_count(kept.limit(0)) == ev.MIN_BUCKETS


def test_small_selections_leave_the_features_in_place(events, kept):
    plan = plan_of(st.attach_position(events, kept))
    assert feature_exchanges(plan) == 0


def test_statistics_combine_before_the_shuffle(events):
    plan = plan_of(stt.feature_stats(events, mc=False))
    partial = plan.index("partial_avg")
    assert plan.index("Exchange hashpartitioning(pos") < partial


def test_scaling_needs_no_shuffle_and_no_join(events):
    norm = stt.feature_stats(events.withColumn("energy", F.lit(2.0)), mc=True)
    plan = plan_of(no.normalize_pixels(events, norm, mc=False))
    assert "Exchange" not in plan and "Join" not in plan


def test_norm_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(no, "MAX_NORM_ROWS", 3)
    norm = spark.range(4).select(F.col("id").alias("pos"), F.lit(0.0).alias("mean"), F.lit(1.0).alias("std"))
    with pytest.raises(ValueError, match="one row per feature"):
        no.norm_arrays(norm)
    with pytest.raises(ValueError, match="without gaps"):
        no.norm_arrays(norm.filter("pos > 1"))


def test_norm_resolution(events, spark):
    given = spark.createDataFrame([(0, 0.0, 1.0)], "pos int, mean double, std double")
    assert resolve_norm("data", given, events).collect() == given.collect()
    with pytest.raises(ValueError, match="norm from simulation"):
        resolve_norm("data", None, events)
    built = resolve_norm("mc", None, events.withColumn("energy", F.lit(2.0)))
    assert built.count() == WIDTH + 3


def test_preprocess_refuses_unknown_options(events):
    with pytest.raises(ValueError):
        preprocess("raw", events)
    with pytest.raises(ValueError):
        preprocess("data", events, normalize="linewise")
    norm = events.limit(0)
    for late in ({}, {"norm": norm, "normalize": "camerawise"}, {"normalize": None, "make_predict_fn": len}):
        with pytest.raises(ValueError):
            preprocess("data", None, **late)


def test_steps_can_be_switched_off(events):
    done = preprocess("data", events, normalize=None)
    assert done.normalized is None and done.energies is None
    assert {r["status"] for r in done.status.collect()} == {"ok"}
    assert done.stereo.count() == events.filter("tel = 'M1'").count()


def test_shared_folder_follows_the_setting(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scaler_values(spark):
    from duoscope.functions.arrays import array_scaler

    inf = float("inf")
    df = spark.createDataFrame(
        [([1.0, 5.0, float("nan")],), ([3.0, 5.0, inf],), (None,), ([2.0, 5.0, -inf],)], "pix array<float>"
    )
    out = [r[0] for r in df.select(array_scaler([1.0, 9.0, 0.0], [2.0, 0.0, 1.0], 7.0)("pix")).collect()]
    assert out == [[0.0, 5.0, 0.0], [1.0, 5.0, 7.0], None, [0.5, 5.0, -7.0]]
    with pytest.raises(Exception, match="must have 2 features"):
        df.select(array_scaler(np.zeros(2), np.ones(2))("pix")).collect()


def test_sample_filters_events_where_they_are(spark, events):
    """No task sorts the sample, and beside the events only the few keys of one hash range are joined."""
    chosen = stt.sample_exact(events, 150, keys=("run", "tel", "seq"))
    assert chosen.count() == 150
    plan = plan_of(chosen)
    assert "TakeOrdered" not in plan and "Exchange hashpartitioning" not in plan and "Window" not in plan
    assert plan.count("FileScan") == 2
