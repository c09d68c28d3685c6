import pytest
from pyspark.sql import functions as F

from duoscope.operators import files as fi
from duoscope.operators import selection as sel
from duoscope.operators import statistics as stt


def named(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def listed(spark, runs):
    return spark.createDataFrame([(r,) for r in runs], "run string")


def test_unpaired_files(spark):
    m1 = named(spark, "d_M1_1_Y_a", "d_M1_2_Y_a")
    m2 = named(spark, "d_M2_1_Y_a", "d_M2_3_Y_a")
    found = {r["key"]: (r["in_left"], r["in_right"]) for r in fi.unpaired_files(m1, m2).collect()}
    assert found == {"d_M2_2_Y_a": (True, False), "d_M2_3_Y_a": (False, True)}
    assert fi.unpaired_files(m1, named(spark, "x/d_M2_1_Y_a", "x/d_M2_2_Y_a")).isEmpty()
    steps = fi.unpaired_files(named(spark, "a_Y_b"), named(spark, "a_I_b"), "_Y_", "_I_")
    assert steps.isEmpty()


def test_missing_partner(spark):
    files = named(spark, "d_M1_1_Y_a", "d_M2_1_Y_a", "d_M1_2_Y_a", "d_M2_3_Y_a")
    found = {(r["name"], r["missing_from"]) for r in fi.missing_partner(files).collect()}
    assert found == {("d_M2_2_Y_a", "M2"), ("d_M1_3_Y_a", "M1")}


def test_run_lists(spark):
    a, b = listed(spark, ["1", "2", "2"]), listed(spark, ["2", "3"])
    assert {tuple(r) for r in fi.missing_runs(a, b).collect()} == {("1", "missing"), ("3", "extra")}
    assert fi.missing_runs(a, a).isEmpty()
    parts = {}
    for r in fi.run_sets(a, b).collect():
        parts.setdefault(r["part"], set()).add(r["run"])
    assert parts == {"both": {"2"}, "left_only": {"1"}, "right_only": {"3"}, "either": {"1", "3"}}


@pytest.mark.parametrize(
    "n_files, n_batches, sizes", [(10, 3, [4, 3, 3]), (10, 0, [10]), (9, 3, [3, 3, 3]), (2, 5, [1, 1])]
)
def test_batches(spark, n_files, n_batches, sizes):
    rows = [(f"f{i:02d}", 100) for i in range(n_files)]
    files = spark.createDataFrame(rows, "name string, bytes long")
    limit = 100 * n_files // n_batches if n_batches else 10**9
    batched = fi.batch_files(files, limit).orderBy("name").collect()
    batches = [r["batch"] for r in batched]
    assert batches == sorted(batches)
    assert [batches.count(b) for b in sorted(set(batches))] == sizes


@pytest.mark.parametrize("n, share, n_train", [(10, 0.6, 5), (1, 0.6, 0), (0, 0.6, 0), (100, 0.29, int(100 * 0.29) - 1), (5, 1.0, 4)])
def test_split_by_run(spark, n, share, n_train):
    runs = listed(spark, [f"{i:03d}" for i in range(n)] * 2)
    rows = fi.train_test_split_runs(runs, share).orderBy("run").collect()
    assert len(rows) == n
    assert [r["side"] for r in rows] == ["train"] * n_train + ["test"] * (n - n_train)
    with pytest.raises(ValueError):
        fi.train_test_split_runs(runs, 1.5)


def test_sizes(spark):
    a = spark.createDataFrame([(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0])], "batch long, pix array<float>")
    assert all(r["ok"] for r in fi.size_conserved(a, a, "batch").collect())
    found = {r["batch"]: (r["cells_before"], r["cells_after"], r["ok"]) for r in fi.size_conserved(a, a.filter("batch = 0"), "batch").collect()}
    assert found == {0: (4, 4, True), 1: (1, 0, False)}


def test_counts_of_both_telescopes(spark):
    rows = [("a", "M1", 5, 5), ("a", "M2", 5, 5), ("b", "M1", 4, 5), ("b", "M2", 5, 5), ("c", "M1", 3, 5), ("c", "M2", 3, 5)]
    status = spark.createDataFrame(rows, "run string, tel string, n_kept long, n_ref long")
    assert {r["run"]: r["ok"] for r in fi.count_mismatch(status).collect()} == {"a": True, "b": False, "c": False}


def test_stages(spark):
    a = spark.createDataFrame([("r", [1.0]), ("r", [1.0]), ("s", [1.0])], "run string, pix array<float>")
    shapes = stt.stage_shapes({"filtered": a, "merged": a.filter("run = 'r'")})
    found = {r["run"]: r["ok"] for r in stt.stage_reconcile(shapes, ["filtered", "merged"]).collect()}
    assert found == {"r": True, "s": False}


def test_quality_list_of_both_telescopes(spark):
    files = named(spark, *[f"d_M{t}_{r}_Y_a" for r in (1, 2, 3) for t in (1, 2)])
    passed = named(spark, "d_M1_1_Y_a", "d_M2_1_Y_a", "d_M1_2_Y_a", "d_M2_3_Y_a")
    good, bad = sel.quality_cut(files, passed)
    assert {r["name"] for r in good.collect()} == {"d_M1_1_Y_a", "d_M2_1_Y_a"}
    assert bad.count() == 4


def test_subruns_and_completeness(spark):
    files = spark.createDataFrame(
        [("a", "M1", "001"), ("a", "M1", "002"), ("a", "M2", "001"), ("b", "M1", "001")],
        "run string, tel string, subrun string",
    )
    valid = spark.createDataFrame([("a", "001"), ("a", "002"), ("c", "001")], "run string, subrun string")
    assert sel.keep_valid_subruns(files, valid).count() == 3
    found = {(r["run"], r["tel"]): r["complete"] for r in sel.complete_runs(files, valid).collect()}
    assert found == {("a", "M1"): True, ("a", "M2"): False, ("c", "M1"): False, ("c", "M2"): False}
    with pytest.raises(ValueError, match="no events left"):
        keys = [F.lit(1.0).alias(k) for k in ("nanotime", "time2")] + [F.lit(1).cast("long").alias("id")]
        events = files.filter("run = 'b'").select("run", "tel", "subrun", F.lit(0).cast("long").alias("seq"), *keys)
        sel.select_events(events, events.withColumnRenamed("seq", "sseq"), valid)


def test_small_selections(spark):
    events = spark.createDataFrame(
        [(r, t, s) for r in ("a", "b") for t in ("M1", "M2") for s in range(3)], "run string, tel string, seq long"
    )
    assert sel.skip_done(events, listed(spark, ["a", "a"])).select("run").distinct().collect()[0]["run"] == "b"
    kept = events.filter("seq < 2").withColumn("sseq", F.col("seq"))
    assert {r["seq"] for r in sel.rejected_events(events, kept).collect()} == {2}
    other = events.filter("seq > 0").withColumn("sseq", F.col("seq"))
    diff = sel.cleaning_diff(kept, other)
    assert {(r["seq"], r["in_first"]) for r in diff.collect()} == {(0, True), (2, False)}
    assert sel.events_in_diff(events, diff).count() == 8
    names = named(spark, "c", "a", "b")
    assert sorted(r["name"] for r in sel.from_nth_file(names, 2).collect()) == ["b", "c"]
    table = events.filter("tel = 'M1'").select("run", "seq", F.lit(1.0).alias("x"))
    assert sel.filter_aligned(table, kept.filter("tel = 'M1'")).count() == 4
