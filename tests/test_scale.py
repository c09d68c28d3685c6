"""What is written, gathered and broadcast when tables grow."""

import os

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import QUERIES
from duoscope.operators import files as fi
from duoscope.operators import matching
from duoscope.operators import selection as sel
from duoscope.operators import statistics as stt
from duoscope.operators import stereo as st
from duoscope.operators.ordering import with_occurrence
from duoscope.plans.resume import Preparation
from duoscope.sources import events as ev
from duoscope.sources import shared
from duoscope.sources.shared import written
from duoscope.streaming.ingest import land_calib, landed_events
from workload import tables as t
from workload.fixtures import write_files
from workload.source_queries import write_keys


def part_files(folder):
    return [name for _, _, names in os.walk(folder) for name in names if name.startswith("part-")]


def test_narrow_tables_are_as_large_as_their_rows(spark):
    """Positions compress to next to nothing; the driver must not collect them for a broadcast."""
    rows = spark.range(600_000).select(
        F.lpad((F.col("id") / 100).cast("int").cast("string"), 8, "0").alias("run"),
        F.lit("M1").alias("tel"),
        (F.col("id") % 100).alias("seq"),
        (F.col("id") % 100).alias("sseq"),
    )
    stored = written(rows, "scale-positions")
    events = stored.withColumn("pix", F.array(F.lit(1.0)))
    plan = st.attach_position(events, stored)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_tables_of_texts_are_stored_compressed(spark, monkeypatch):
    """Only keys and positions are stored plainly; binary cells hold whole texts."""
    paths = []
    folder = shared.shared_folder
    monkeypatch.setattr(shared, "shared_folder", lambda *a: paths.append(folder(*a)) or paths[-1])
    texts = spark.range(2000).select("id", F.repeat(F.lit("some words "), 100).cast("binary").alias("data"))
    assert written(texts, "scale-texts").count() == 2000
    size = sum(os.path.getsize(os.path.join(paths[0], name)) for name in part_files(paths[0]))
    assert size < 2000 * 1100 / 10


def test_events_of_a_file_are_gathered_before_they_are_taken_apart(spark):
    rows = spark.range(60).select(
        (F.col("id") % 3).cast("string").alias("run"),
        F.col("id").cast("double").alias("zd"),
        F.lit(1.0).alias("az"),
        F.array(F.col("id").cast("float")).alias("pix"),
    )
    norm = stt.mean_of_file_stats(rows.repartition(7), mc=False)
    plan = norm._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan.split("Generate")[-1]
    assert [r["mean"] for r in norm.orderBy("pos").collect()] == pytest.approx([29.5, 29.5, 1.0])


def test_a_batch_is_not_one_file_per_task(spark, folder):
    rows = spark.range(60).select((F.col("id") % 3).alias("batch"), F.lit("x").alias("name"), "id").repartition(7)
    fi.write_batches(rows, f"{folder}/out")
    assert len(part_files(f"{folder}/out")) == 3
    assert spark.read.parquet(f"{folder}/out").count() == 60


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Six runs of twenty events and their features."""
    place = str(tmp_path_factory.mktemp("small"))
    day = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 9000)
    spark.range(120).select(
        F.col("id").alias("event_id"),
        day.alias("ts"),
        (F.col("id") % 6).alias("user_id"),
        F.when(F.col("id") % 5 == 0, "error").otherwise("click").alias("event_type"),
        (F.col("id") + 1.5).alias("value"),
    ).write.parquet(f"{place}/events.parquet")
    pix = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: (i + F.col("id")).cast("float"))
    spark.range(10).select(F.col("id").alias("vec_id"), pix.alias("embedding")).write.parquet(f"{place}/embeddings.parquet")
    return place


def test_events_of_a_join_are_written_run_by_run(spark, small, monkeypatch):
    """One file per run and telescope, however many tasks the joined table has."""
    where, write = [], ev.write_events

    def spy(rows, path, *args, **options):
        where.append(path)
        return write(rows.repartition(7), path, *args, **options)

    monkeypatch.setattr(ev, "write_events", spy)
    rows = QUERIES["write_events"](spark, small)
    assert rows.count() == t.calib(spark, small).count()
    groups = t.calib(spark, small).select("run", "tel").distinct().count()
    assert len(set(where)) == 1 and len(part_files(where[0])) == groups


def test_keys_are_read_without_writing_features(spark, small):
    columns = spark.read.parquet(*t.calib(spark, small).inputFiles()).columns
    assert "pix" not in columns and {"run", "tel", "seq", "nanotime", "time2", "id"} <= set(columns)


def test_keys_are_those_of_the_events_with_features(spark, small, folder):
    """A row of features that comes twice doubles its events in either table."""
    spark.read.parquet(f"{small}/events.parquet").write.parquet(f"{folder}/events.parquet")
    twice = spark.read.parquet(f"{small}/embeddings.parquet")
    twice.unionByName(twice.filter("vec_id = 3")).write.parquet(f"{folder}/embeddings.parquet")
    key = ["run", "tel", "seq"]
    keys, events = (sorted(map(tuple, rows.select(key).collect())) for rows in (t.calib(spark, folder), t.calib_events(spark, folder)))
    assert keys == events and len(keys) > len(set(keys))


def test_tasks_of_day_files_are_bounded_in_rows(spark, small, monkeypatch):
    """Narrow rows are not merged into few tasks before their features are joined to them."""
    monkeypatch.setattr(t, "DAY_ROWS", 10)
    plan = t.day_events(spark, small)._jdf.queryExecution().executedPlan().toString()
    ranges = next(line for line in plan.splitlines() if "Exchange rangepartitioning" in line)
    assert ", 24), REPARTITION_BY_NUM" in ranges


def test_last_rows_are_found_on_the_keys(spark):
    kept = spark.createDataFrame(
        [("a", "M1", s, 10 * s) for s in range(4)] + [("a", "M2", 0, 5)], "run string, tel string, sseq long, seq long"
    )
    assert sorted(tuple(r) for r in st.last_rows(kept).collect()) == [("a", "M1", 2, 20), ("a", "M1", 3, 30), ("a", "M2", 0, 5)]


def test_key_files_are_not_listed_to_infer_their_columns(spark, folder, monkeypatch):
    for run in range(3):
        with open(f"{folder}/2024_{run}_S_x.csv", "w") as out:
            out.write("nanotime_1,time2_1,id_1,nanotime_2,time2_2,id_2\n1,2,3,4,5,6\n")
    asked, look = [], ev.require_nonempty

    def spy(spark, path, fmt="text", schema=None, **options):
        asked.append((fmt, schema))
        return look(spark, path, fmt, schema, **options)

    monkeypatch.setattr(ev, "require_nonempty", spy)
    assert ev.read_stereo_keys(spark, folder).count() == 6
    assert all(schema is not None for fmt, schema in asked if fmt == "csv")


def test_files_of_selected_events_do_not_follow_the_runs(spark, folder):
    """A hundred runs in four folders; a rewritten run is replaced, those that share its folder stay."""
    rows = spark.range(400).selectExpr(
        "concat('r', id % 100) run", "if(id % 200 < 100, 'M1', 'M2') tel", "id as sseq", "array(cast(id as float)) pix"
    )
    ev.write_filtered(rows.repartition(7), folder + "/out", 4)
    assert len(part_files(f"{folder}/out")) <= 4
    other = rows.filter("run in ('r3', 'r4') and tel = 'M1'").withColumn("sseq", -F.col("sseq"))
    again = ev.write_filtered(other, folder + "/out", 4)
    want = rows.filter("run not in ('r3', 'r4')").unionByName(other)
    key = ["run", "tel", "sseq"]
    found = sorted(map(tuple, again.select(key).collect()))
    assert found == sorted(map(tuple, want.select(key).collect())) and len(found) == 396


def test_folders_are_listed_by_few_tasks(spark):
    before = spark.conf.get(shared.LISTING_CONF)
    with shared.many_folders(spark):
        assert int(spark.conf.get(shared.LISTING_CONF)) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(shared.LISTING_CONF) == before


def test_stages_have_no_folder_per_run(spark, folder):
    prep = Preparation(spark, folder + "/out")
    rows = spark.range(6).selectExpr("concat('0', id % 3) run", "'M1' tel", "id as sseq", "array(cast(id as float)) pix")
    prep._write("stereo", rows.selectExpr("run", "tel", "-1L sseq", "pix"))  # an attempt that was lost before its manifest
    prep._finish("stereo", rows, rows.select("run").distinct())
    assert {r["sseq"] for r in prep.table("stereo").collect()} == set(range(6))
    assert not [f for f in part_files(folder + "/out/stereo") if "run=" in str(f)]


KEYS = "run string, tel string, nanotime double, time2 double, id long"


def few_keys(spark, position):
    """A run whose keys repeat in mixed order: only a walk tells the partners."""
    ids = {"seq": [1, 2, 1, 2, 2], "sseq": [2, 1, 2]}[position]
    return spark.createDataFrame([("a", "M1", 0.0, 0.0, k, i) for i, k in enumerate(ids)], f"{KEYS}, {position} long")


def test_runs_of_one_block_are_walked_without_bounds(spark, monkeypatch):
    monkeypatch.setattr(matching, "_windows", None)
    match = matching.match_events(few_keys(spark, "seq"), few_keys(spark, "sseq"))
    assert [tuple(r)[2:] for r in match.kept.orderBy("sseq").collect()] == [(0, 1), (1, 2), (2, 3)]
    assert [r["status"] for r in match.status.collect()] == ["ok"]


def test_counts_between_blocks_need_long_groups(spark):
    rows = few_keys(spark, "seq")
    short, long_ones = (with_occurrence(rows, ["run"], ["id"], "seq", block) for block in (10, 2))
    joins = [rows._jdf.queryExecution().optimizedPlan().toString().count("Join") for rows in (short, long_ones)]
    assert joins[0] == 0 and joins[1] > 0
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, long_ones.collect()))


def test_the_match_reads_keys_that_are_restricted_already(spark, monkeypatch):
    """The lists of valid subruns and usable runs are joined to the keys once, not at each reading."""
    seen, match = [], sel.match_events
    monkeypatch.setattr(sel, "match_events", lambda calib, stereo, *a, **o: seen.extend([calib, stereo]) or match(calib, stereo, *a, **o))
    keys = spark.createDataFrame([("a", tel, 1.0, 2.0, k) for tel in ("M1", "M2") for k in range(3)], KEYS)
    events = keys.selectExpr("*", "'000' subrun", "id as seq")
    stereo, valid = keys.selectExpr("*", "id as sseq"), spark.createDataFrame([("a", "000"), ("b", "000")], "run string, subrun string")
    assert sel.select_events(events, stereo, valid).kept.count() == 6
    assert len(seen) == 2 and not any("Join" in rows._jdf.queryExecution().optimizedPlan().toString() for rows in seen)


def test_events_of_runs_without_kept_rows_are_not_shuffled(spark, monkeypatch):
    events = spark.range(40).selectExpr(
        "concat('r', id % 4) run", "if(id < 20, 'M1', 'M2') tel", "id % 20 as seq", "array(cast(id as float)) pix"
    )
    kept = written(events.filter("run = 'r1'").selectExpr("run", "tel", "seq", "seq as sseq"), "scale-kept")
    listed = st.stereo_of_kept(events, kept)
    assert "LeftSemi" in listed._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(st, "LISTED_RUNS", 0)
    whole = st.stereo_of_kept(events, kept)
    assert "LeftSemi" not in whole._jdf.queryExecution().optimizedPlan().toString()
    rows = [sorted((r["run"], r["sseq"], tuple(r["pix"])) for r in found.collect()) for found in (listed, whole)]
    assert rows[0] == rows[1] and len(rows[0]) == 5


def test_paths_of_many_files_are_fetched_in_few_jobs(spark, folder):
    """The driver does not run one job for every few files that it lists."""
    for number in range(40):
        with open(f"{folder}/20240101_M1_{number:08d}.001_Y_Src.csv", "w") as out:
            out.write(f"{number}.5,1,{number},1,20,90\n")
    files = ev.listed_files(spark, folder).repartition(40)
    scheduler = spark.sparkContext._jsc.sc().dagScheduler()
    before = scheduler.numTotalJobs()
    lines = ev.text_of(spark, files)
    assert scheduler.numTotalJobs() - before < 2 * spark.sparkContext.defaultParallelism
    assert lines.count() == 40


def test_input_files_lie_in_the_folders_of_their_names(spark, folder):
    """Two calls with the same names add files; lines keep their order."""
    lines = spark.createDataFrame([(f"f{i // 3}", f"{i},ä") for i in range(9)] + [(None, "x")], "name string, value string")
    for _ in range(2):
        write_files(lines.repartitionByRange(2, "name").sortWithinPartitions("name", "value"), f"{folder}/land")
    names = sorted(os.listdir(f"{folder}/land"))
    assert names == ["name=__HIVE_DEFAULT_PARTITION__", "name=f0", "name=f1", "name=f2"]
    parts = part_files(f"{folder}/land/name=f1")
    assert len(parts) == 2
    for part in parts:
        with open(f"{folder}/land/name=f1/{part}", encoding="utf-8") as text:
            assert text.read() == "3,ä\n4,ä\n5,ä\n"
    assert spark.read.text(f"{folder}/land").count() == 20


@pytest.mark.parametrize("gather", [True, False])
def test_files_of_events_do_not_follow_the_groups(spark, folder, gather):
    """Two hundred groups in four folders; new groups are added, rewritten ones replaced, all others stay."""
    rows = spark.range(400).selectExpr(
        "if(id % 100 = 9, null, concat('0', id % 100)) run", "if(id % 200 < 100, 'M1', 'M2') tel", "id as seq", "array(cast(id as double)) pix"
    ).repartition(3)

    def write(given):
        return ev.write_events(given, f"{folder}/out", ("run", "tel"), gather, parts=4)

    write(rows.filter("tel = 'M1'"))
    assert len(part_files(f"{folder}/out")) <= (4 if gather else 12)
    write(rows.filter("tel = 'M2'"))
    assert len(part_files(f"{folder}/out")) <= (8 if gather else 24)
    changed = rows.filter("tel = 'M1' and (run is null or run in ('03', '04'))").withColumn("seq", -F.col("seq"))
    more = changed.filter("run = '03'").withColumn("run", F.lit("new"))
    found = write(changed.unionByName(more))
    want = rows.filter("tel = 'M2' or not (run is null or run in ('03', '04'))").unionByName(changed).unionByName(more)
    key = ["run", "tel", "seq"]
    assert found.columns == rows.columns and dict(found.dtypes)["pix"] == "array<float>"
    same = [sorted((str(r["run"]), r["tel"], r["seq"]) for r in table.select(key).collect()) for table in (found, want)]
    assert same[0] == same[1] and len(same[0]) == 402


def test_folders_without_rewritten_groups_are_not_touched(spark, folder):
    rows = spark.range(60).selectExpr("concat('r', id % 20) run", "id as seq", "array(cast(id as float)) pix")
    ev.write_events(rows, f"{folder}/out", gather=True, parts=8)

    def files():
        return {os.path.join(place, name) for place, _, names in os.walk(f"{folder}/out") for name in names if name.startswith("part-")}

    before = files()
    ev.write_events(rows.filter("run = 'r5'"), f"{folder}/out", gather=True, parts=8)
    assert len(before - files()) == 1
    assert ev.read_events(spark, f"{folder}/out").count() == 60


def test_scans_with_their_features_are_stored_packed(spark, folder, monkeypatch):
    """A scan is stored beside its text: as small as it gets."""
    os.mkdir(f"{folder}/text")
    with open(f"{folder}/text/20240101_M1_00000001.001_Y_Src.csv", "w") as out:
        out.writelines(f"{i}.5,1,{i},{i},{i + 1},20,90\n" for i in range(30))
    paths, place = [], shared.shared_folder
    monkeypatch.setattr(shared, "shared_folder", lambda *a: paths.append(place(*a)) or paths[-1])
    scanned = ev.with_seq(ev.read_calib(spark, f"{folder}/text"))
    land_calib(spark, f"{folder}/text", f"{folder}/landed", f"{folder}/marks")
    for rows in (scanned, landed_events(spark, f"{folder}/landed")):
        assert sorted((r["seq"], r["id"]) for r in rows.collect()) == [(i, i) for i in range(30)]
    table = ev.store_calib(spark, f"{folder}/text", f"{folder}/table")
    assert sorted((r["seq"], r["id"]) for r in table.collect()) == [(i, i) for i in range(30)]
    for where in (paths[0], f"{folder}/landed", f"{folder}/table"):
        stored = [name for name in part_files(where) if name.endswith("parquet")]
        assert stored and all(".zstd." in name for name in stored)


def test_input_is_looked_at_in_one_task(spark, folder):
    """Whether there are rows at all is not asked of every partition of a scan."""
    for run in range(40):
        with open(f"{folder}/2024_{run}_S_x.csv", "w") as out:
            out.write("nanotime_1,time2_1,id_1,nanotime_2,time2_2,id_2\n1,2,3,4,5,6\n")
    cost = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(cost)
    scheduler, tracker = spark.sparkContext._jsc.sc().dagScheduler(), spark.sparkContext.statusTracker()
    spark.conf.set(cost, "128m")  # a partition for each file
    try:
        first = scheduler.numTotalJobs()
        rows = ev.require_nonempty(spark, folder, "csv", recursiveFileLookup="true", header="true", schema="a string")
        jobs = [tracker.getJobInfo(number) for number in range(first, scheduler.numTotalJobs())]
        assert sum(tracker.getStageInfo(stage).numTasks for job in jobs for stage in job.stageIds) == 1
        assert rows.rdd.getNumPartitions() == 40
    finally:
        spark.conf.set(cost, before)


def test_key_files_are_those_of_the_csv_writer(spark, folder):
    """Header, cells and nulls, read back by name; files of several tasks each have a header."""
    rows = spark.createDataFrame(
        [("20240101_1_S_Src_mergecols.csv", i, i + 0.5, None if i == 2 else 1e20 * i, float("nan")) for i in range(5)],
        "name string, place long, a double, b double, c double",
    )
    write_keys(rows, "place", f"{folder}/tasks")
    rows.drop("place").write.partitionBy("name").option("header", "true").csv(f"{folder}/writer")
    reader = spark.read.options(header="true", inferSchema="true", recursiveFileLookup="true")
    same = [reader.csv(f"{folder}/{kind}").orderBy("a").collect() for kind in ("tasks", "writer")]
    assert str(same[0]) == str(same[1]) and len(same[0]) == 5
    files = [name for _, _, names in os.walk(f"{folder}/tasks") for name in names]
    assert files and set(files) == {"name=20240101_1_S_Src_mergecols.csv"}
