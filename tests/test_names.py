import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from duoscope.functions import names

GOLDEN = [
    # name, run, subrun, tel, step
    ("20160929_M1_05057144.015_I_CrabNebula-W0.40+215_mergecols.csv", "05057144", "015", "M1", "I"),
    ("20161008_M1_05057440.005_Y_CrabNebula-W0.40+215.root", "05057440", "005", "M1", "Y"),
    ("eventfiltered_20161008_05057440.005_Y_CrabNebula-W0.40+215.root", "05057440", "005", None, "Y"),
    ("GA_za05to35_8_1743990to1745989_S_wr_2.root", "1743990to1745989", None, None, "S"),
    ("GA_M1_za35to50_8_1740993_Y_wr.root", "1740993", None, "M1", "Y"),
    ("20161008_05057440_S_CrabNebula-W0.40+215.root", "05057440", None, None, "S"),
    ("20161008_05057440_Q_CrabNebula-W0.40+215.root", "05057440", None, None, "Q"),
]


def one(spark, name, column):
    return spark.createDataFrame([(name,)], "name string").select(column.alias("x")).first()[0]


def test_golden_names(spark):
    files = spark.createDataFrame([(f"/some/dir/{g[0]}",) for g in GOLDEN], "name string")
    rows = {r["name"].rsplit("/", 1)[1]: r for r in names.with_name_parts(files).collect()}
    for name, run, subrun, tel, step in GOLDEN:
        row = rows[name]
        assert (row["run"], row["subrun"], row["tel"], row["step"]) == (run, subrun, tel, step), name
        assert row["is_mc"] == name.startswith("GA_")


@pytest.mark.parametrize(
    "name, expected",
    [
        (
            "normalized_eventfiltered_20170119_05059876_I_CrabNebula-W0.40+035.hdf5_application.txt",
            "normalized_eventfiltered_20170119_05059876_I_CrabNebula-W0_x.txt",
        ),
        (
            "normalized_20170120_05059934.001_I_CrabNebula-W0.40+215.hdf5_application.txt",
            "normalized_20170120_05059934.001_I_CrabNebula-W0_x.txt",
        ),
        ("GA_M2_za05to35_8_164228_Y_w0.txt", "GA_M2_za05to35_8_164228_Y_w0_x.txt"),
        ("./normalized_20160929_05057148._I_CrabNebula.hdf5", "05057148_x.txt"),
        (
            "normalized_merged_GA_M1_1737991_TO_1739490_Y_wr.hdf5_validation_val.txt",
            "normalized_merged_GA_M1_1737991_TO_1739490_Y_wr_x.txt",
        ),
    ],
)
def test_energy_names(spark, name, expected):
    assert one(spark, name, names.energy_name(F.col("name"), "_x.txt")) == expected


@pytest.mark.parametrize(
    "column",
    [
        names.run_of,
        names.id_of,
        names.time_token,
        names.run_level_name,
        names.energy_name,
    ],
)
def test_unknown_names_are_errors(spark, column):
    with pytest.raises(PySparkException):
        one(spark, "notes", column(F.col("name")))


def test_number_key_refuses_simulation(spark):
    assert one(spark, "file_0042_x.txt", names.number_key(F.col("name"))) == 42
    with pytest.raises(PySparkException):
        one(spark, "GA_1.txt", names.number_key(F.col("name")))


def test_ids_batches_and_spans(spark):
    mergecols = "./some/dir/GA_za05to35_8_1737992_Q_wr_mergecols.csv"
    assert one(spark, mergecols, names.id_of(F.col("name"))) == "1737992"
    assert one(spark, "GA_M2_za05to35_8_1740969_Y_wr.root", names.batch_key(F.col("name"))) == "17409"
    assert one(spark, "20161008_M1_1_Y_a.csv", names.batch_key(F.col("name"))) == "20161008"
    files = spark.createDataFrame(
        [
            ("b", "GA_M1_za05to35_8_1737993_Y_wr.root"),
            ("b", "GA_M1_za05to35_8_1737995_Y_wr.root"),
            ("b", "GA_M1_za05to35_8_1737994_Y_wr.root"),
        ],
        "batch string, name string",
    )
    row = names.batch_spans(files).first()
    assert row["span"] == "1737993_TO_1737995"
    assert row["span_name"] == "GA_M1_za05to35_1737993_TO_1737995_Y_wr.root"


def test_source_name_of_spark_folders(spark):
    path = "file:/x/name=20240101_M1_00000001.001_Y_Src.csv/part-00000-abc.txt"
    assert one(spark, path, names.source_name(F.col("name"))) == "20240101_M1_00000001.001_Y_Src.csv"
    path = "file:/x/2024_01_01/20240101_M1_00000001.001_Y_Src.csv"
    assert one(spark, path, names.source_name(F.col("name"))) == "20240101_M1_00000001.001_Y_Src.csv"


def test_source_name_below_folders_with_step_letters(spark):
    name = "20240101_M1_00000001.001_Y_Src.csv"
    for path in (f"/x/good_S_archive/{name}", f"/x/all_Q_y/name={name}/part-0.csv", f"/a_I_b/c_S_d/{name}/part-1"):
        assert one(spark, path, names.source_name(F.col("name"))) == name
