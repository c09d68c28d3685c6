import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from duoscope.operators import energy as en
from duoscope.operators import statistics as stt
from duoscope.plans.energies import energies
from duoscope.sources import events as ev
from duoscope.sources import tables as tab
from duoscope.streaming.ingest import land_calib, landed_events

DATA_NAME = "20240101_{tel}_05057144.{sub}_Y_Crab-W0.40+215.csv"
MC_NAME = "GA_M1_za05to35_8_1737992_Y_wr.csv"


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.write("\n".join(lines) + "\n")


def data_lines(first, n, tel=0):
    return [f"{i}.5,{i},{i},{i},1.5,bad,{i + tel},30,{i}" for i in range(first, first + n)]


def test_observed_and_simulated_rows(spark, folder):
    put(folder, DATA_NAME.format(tel="M1", sub="001"), data_lines(0, 2))
    put(folder, MC_NAME, ["250.5,7,1,2,3,4,20,100"])
    rows = {r["is_mc"]: r for r in ev.read_calib(spark, folder).orderBy("id").collect()}
    data, mc = rows[False], rows[True]
    assert (data["run"], data["subrun"], data["tel"]) == ("05057144", "001", "M1")
    assert (data["nanotime"], data["time2"], data["id"], data["energy"]) == (1.5, 1.0, 1, None)
    assert data["pix"][:2] == [1.0, 1.5] and data["pix"][2] != data["pix"][2]
    assert (data["zd"], data["az"]) == (30.0, 1.0)
    assert (mc["energy"], mc["id"], mc["nanotime"], mc["pix"]) == (250.5, 7, None, [1.0, 2.0, 3.0, 4.0])
    assert (mc["zd"], mc["az"], mc["run"]) == (20.0, 100.0, "1737992")


def test_positions_follow_names_and_lines(spark, folder):
    """Many splits per file: the position is that of the line in the stacked files."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    try:
        for day, start in (("2024_01_01", 0), ("2024_01_02", 1000)):
            for number, sub in enumerate(("001", "002")):
                name = DATA_NAME.format(tel="M1", sub=sub).replace("20240101", day.replace("_", ""))
                put(f"{folder}/{day}", name, data_lines(start + 300 * number, 200))
        rows = ev.with_seq(ev.read_calib(spark, f"{folder}/20*")).select("id", "seq")
        assert spark.read.option("recursiveFileLookup", "true").text(folder).rdd.getNumPartitions() > 8
        wanted = [i for start in (0, 1000) for n in (0, 1) for i in range(start + 300 * n, start + 300 * n + 200)]
        assert [r["id"] for r in rows.orderBy("seq").collect()] == wanted
        assert sorted(r["seq"] for r in rows.collect()) == list(range(800))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_of_other_subruns_are_not_opened(spark, folder):
    """They are no text at all here; opening one would fail the scan. Names may look like patterns."""
    for day, sub in (("day[1]", "001"), ("day{2}", "002"), ("day*", "003")):
        put(f"{folder}/{day}", DATA_NAME.format(tel="M1", sub=sub), data_lines(10 * int(sub), 2))
    broken = DATA_NAME.format(tel="M2", sub="004") + ".gz"
    put(f"{folder}/day[1]", broken, ["no gzip"])
    put(f"{folder}/day[1]", MC_NAME, ["250.5,7,1,2,3,4,20,100"])
    put(f"{folder}/day[1]", "notes.txt", ["not an event file"])
    valid = [("05057144", "001"), ("05057144", "002"), ("05057144", "002"), ("1737992", "001"), ("9", "003")]
    pairs = spark.createDataFrame(valid, "run string, subrun string")
    rows = ev.read_calib(spark, folder, pairs)
    assert sorted(r["id"] for r in rows.collect()) == [7, 10, 11, 20, 21]
    opened = {name.rsplit("/", 1)[1] for name in rows.inputFiles()}
    assert len(opened) == 3 and broken not in opened
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        ev.read_calib(spark, folder, pairs.union(spark.createDataFrame([("05057144", "004")], pairs.schema))).collect()
    with pytest.raises(FileNotFoundError, match="valid subrun"):
        ev.read_calib(spark, folder, pairs.limit(0))
    stored = ev.store_calib(spark, folder, f"{folder}/table", pairs.filter("subrun = '002'"))
    assert sorted((r["id"], r["seq"]) for r in stored.collect()) == [(20, 0), (21, 1)]


def test_lines_round_trip(spark, folder):
    put(folder, DATA_NAME.format(tel="M1", sub="001"), [x.replace("bad", "nan") for x in data_lines(0, 5)])
    rows = ev.read_calib(spark, folder)
    again = ev.parse_calib(ev.calib_lines(rows))
    columns = ["id", "nanotime", "zd", "az", F.col("pix").cast("string")]
    assert again.select(*columns).orderBy("id").collect() == rows.select(*columns).orderBy("id").collect()


def test_no_input_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError, match="the folder exists"):
        ev.read_calib(spark, f"{folder}/*.csv")
    with pytest.raises(FileNotFoundError, match="does not exist either"):
        ev.read_calib(spark, f"{folder}/nowhere/*.csv")


def test_stereo_keys(spark, folder):
    head = "nanotime_1,time2_1,id_1,nanotime_2,time2_2,id_2"
    put(folder, "20240101_05057144_S_Crab_mergecols.csv", [head, "1,2,3,4,5,6", "7,8,9,10,11,12"])
    rows = ev.read_stereo_keys(spark, folder).orderBy("sseq", "tel").collect()
    assert [tuple(r) for r in rows] == [
        ("05057144", 0, "M1", 1.0, 2.0, 3),
        ("05057144", 0, "M2", 4.0, 5.0, 6),
        ("05057144", 1, "M1", 7.0, 8.0, 9),
        ("05057144", 1, "M2", 10.0, 11.0, 12),
    ]


def test_mc_stereo_keys(spark, folder):
    head = "mcE_1,id_1,zd_1,az_1,mcE_2,id_2,zd_2,az_2"
    put(folder, "GA_za05to35_8_1737992_S_wr_mergecols.csv", [head, "250.5,3,20,100,250.5,4,21,101"])
    rows = ev.read_stereo_keys(spark, folder, mc=True).orderBy("tel").collect()
    assert [tuple(r) for r in rows] == [
        ("1737992", 0, "M1", 250.5, 3, 20.0, 100.0),
        ("1737992", 0, "M2", 250.5, 4, 21.0, 101.0),
    ]


def test_manifest_sizes(spark, folder):
    put(folder, DATA_NAME.format(tel="M1", sub="001"), ["abc"])
    rows = ev.file_manifest(spark, folder).collect()
    assert [tuple(r) for r in rows] == [(DATA_NAME.format(tel="M1", sub="001"), 4)]


def test_rewriting_a_run_leaves_the_others(spark, folder):
    put(f"{folder}/in", DATA_NAME.format(tel="M1", sub="001"), data_lines(0, 4))
    put(f"{folder}/in", DATA_NAME.format(tel="M1", sub="001").replace("05057144", "05057145"), data_lines(50, 3))
    rows = ev.read_calib(spark, f"{folder}/in")
    out = f"{folder}/out"
    ev.write_filtered(rows, out)
    again = ev.write_filtered(rows.filter("run = '05057144' and id < 2"), out)
    assert {r["run"]: r["count"] for r in again.groupBy("run").count().collect()} == {
        "05057144": 2,
        "05057145": 3,
    }


def test_norm_files(spark, folder):
    norm = spark.createDataFrame([(0, 1.5, 0.25), (1, 2.5, 0.0)], "pos int, mean double, std double")
    for fmt in ("csv", "parquet"):
        for _ in range(2):
            stored = tab.write_norm(norm, f"{folder}/{fmt}", fmt)
        assert [tuple(r) for r in stored.orderBy("pos").collect()] == [(0, 1.5, 0.25), (1, 2.5, 0.0)]
    put(f"{folder}/plain", "norm.txt", ["1.5 0.25", "2.5 0.0", "nan 3"])
    plain = tab.read_plain_norm(spark, f"{folder}/plain/norm.txt").orderBy("pos").collect()
    assert [r["pos"] for r in plain] == [0, 1, 2]
    assert plain[1]["mean"] == 2.5 and plain[2]["mean"] != plain[2]["mean"]


def test_energy_files(spark, folder):
    inf = float("inf")
    rows = spark.createDataFrame(
        [("r1", 0, 1.0, 1.5), ("r1", 1, inf, 2.0), ("r1", 2, float("nan"), 3.0), ("r1", 3, -inf, 0.1)],
        "run string, seq long, dl double, mc_truth double",
    )
    paths = tab.write_energies(rows, folder)

    def lines(kind):
        parts = spark.read.option("recursiveFileLookup", "true").text(paths[kind])
        return sorted(r["value"] for r in parts.collect())

    assert lines("impute") == ['""', "0.00000000", "0.00000000", "1.00000000"]
    validate = lines("validate")
    assert "1.50000000,1.00000000" in validate and "2.00000000,inf" in validate
    assert "3.00000000," in validate and "0.10000000,-inf" in validate
    assert "MCTruth,DL" in validate
    only = tab.write_energies(rows, f"{folder}/one", outputs=("impute",))
    assert set(only) == {"impute"}
    assert set(tab.write_energies(rows.drop("mc_truth"), f"{folder}/two")) == {"impute"}
    with pytest.raises(ValueError):
        tab.write_energies(rows, folder, outputs=("all",))


def test_prediction_files_of_one_mode(spark, folder):
    put(folder, "normalized_20240101_05057144.001_I_C.40+2.hdf5_application.txt", ["0 1 2 3", "1 4 5 6"])
    put(folder, "merged_normalized_20240101_05057144_I_C.hdf5_application.txt", ["9 9 9 9"])
    put(folder, "normalized_20240101_05057144_I_C_application.txt_adjusted_impute.txt", ["9"])
    norm = spark.createDataFrame([(0, 0.0, 2.0)], "pos int, mean double, std double")
    rows = energies(spark, folder, norm, "data", out=f"{folder}/out").orderBy("seq").collect()
    assert [(r["run"], r["seq"], r["nanotime"], r["id"]) for r in rows] == [
        ("05057144", 0, 1.0, 3),
        ("05057144", 1, 4.0, 6),
    ]
    assert rows[0]["dl"] == 1.0 and rows[1]["dl"] == pytest.approx(7.38905609893)
    with pytest.raises(ValueError):
        tab.read_predictions(spark, folder, "both")


def test_stream_lands_each_file_once(spark, folder):
    source, table, marks = f"{folder}/in", f"{folder}/landed", f"{folder}/marks"
    put(source, DATA_NAME.format(tel="M1", sub="002"), data_lines(100, 50))
    land_calib(spark, source, table, marks)
    land_calib(spark, source, table, marks)
    assert landed_events(spark, table).count() == 50
    put(source, DATA_NAME.format(tel="M1", sub="001"), data_lines(0, 30))
    land_calib(spark, source, table, marks)
    rows = landed_events(spark, table).orderBy("seq").collect()
    assert [r["id"] for r in rows] == [*range(30), *range(100, 150)]
    assert [r["seq"] for r in rows] == list(range(80))


def test_bad_numbers_never_fail_a_scan(spark, folder):
    put(folder, DATA_NAME.format(tel="M1", sub="001"), ["x,y,z,1,2,3,4,5,6", "1e400,1,99999999999999999999,1,,3,4,5,6"])
    rows = ev.read_calib(spark, folder).collect()
    assert len(rows) == 2
    assert all(r["id"] is None for r in rows)


def test_unnamed_files_are_refused(spark, folder):
    put(folder, "notes.csv", ["1,2,3,4,5"])
    with pytest.raises(PySparkException):
        ev.read_calib(spark, folder).collect()


def test_rows_per_file(spark, folder):
    put(folder, DATA_NAME.format(tel="M1", sub="001"), data_lines(0, 4))
    put(folder, DATA_NAME.format(tel="M2", sub="001"), data_lines(0, 3))
    counted = stt.rows_per_file(ev.read_calib(spark, folder)).collect()
    assert {r["name"]: r["n_rows"] for r in counted} == {
        DATA_NAME.format(tel="M1", sub="001"): 4,
        DATA_NAME.format(tel="M2", sub="001"): 3,
    }


def test_prediction_modes(spark):
    files = spark.createDataFrame(
        [("a_application.txt",), ("a_application.txt",), ("b_validation_val.txt",), ("x/merged_a_application.txt",)],
        "name string",
    )
    assert [r["name"] for r in en.prediction_inputs(files, "data").collect()] == ["a_application.txt"]
    assert [r["name"] for r in en.prediction_inputs(files, "mc").collect()] == ["b_validation_val.txt"]
    with pytest.raises(ValueError):
        en.prediction_inputs(files, "raw")


def test_blank_and_torn_lines(spark, folder):
    good = [x.replace("bad", "2.0") for x in data_lines(0, 3)]
    name = DATA_NAME.format(tel="M1", sub="001")
    put(folder, name, [good[0], "", "  ", good[1], "7.5", "8.5,8,9", "1,2,3,4,5,6,7,8,9,10,11", good[2]])
    rows = ev.with_seq(ev.read_calib(spark, folder)).orderBy("seq").collect()
    assert [r["seq"] for r in rows] == list(range(6))
    assert [r["id"] for r in rows] == [0, 1, None, 9, 3, 2]
    assert [len(r["pix"]) for r in rows] == [4, 4, 0, 0, 6, 4]
    assert rows[2]["nanotime"] == 7.5 and rows[2]["time2"] != rows[2]["time2"]
    found = ev.malformed_lines(ev.calib_text(spark, folder)).first()
    assert (found["n_lines"], found["n_cells"], found["n_short"], found["n_empty"]) == (6, 11, 5, 2)


def test_keys_go_by_the_header(spark, folder):
    put(folder, "20240101_05057144_S_Src_mergecols.csv", ["id_1,other,nanotime_1,time2_1,id_2,time2_2,nanotime_2", "7,x,1.5,2,8,4,3.5"])
    rows = {r["tel"]: (r["nanotime"], r["time2"], r["id"]) for r in ev.read_stereo_keys(spark, folder).collect()}
    assert rows == {"M1": (1.5, 2.0, 7), "M2": (3.5, 4.0, 8)}
    put(folder, "20240102_05057145_S_Src_mergecols.csv", ["nanotime_1,other,id_1,time2_1,id_2,time2_2,nanotime_2", "7,x,1.5,2,8,4,3.5"])
    with pytest.raises(Exception, match="CSV header"):
        ev.read_stereo_keys(spark, folder).collect()


def test_energies_of_other_runs_stay(spark, folder):
    for run, values in (("r1", [1.0, 2.0]), ("r2", [3.0]), ("r1", [4.0])):
        rows = spark.createDataFrame([(run, i, v) for i, v in enumerate(values)], "run string, seq long, dl double")
        path = tab.write_energies(rows, f"{folder}/out")["impute"]
    lines = sorted((r["run"], r["value"]) for r in spark.read.text(path).collect())
    assert lines == [("r1", "4.00000000"), ("r2", "3.00000000")]


def test_plain_norm(spark, folder):
    norm = spark.createDataFrame([(2, 0.5, 3.0), (0, 1.5, 1.0), (1, -2.0, 0.0)], "pos int, mean double, std double")
    again = tab.write_plain_norm(norm, f"{folder}/norm")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, norm.collect()))
    assert len([f for f in os.listdir(f"{folder}/norm") if f.startswith("part-")]) == 1
