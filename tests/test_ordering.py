import random

import pytest
from pyspark.sql import functions as F

from duoscope.operators import selection as sel
from duoscope.operators.ordering import block_of, number_rows, running_max, with_occurrence


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [("hot" if rng.random() < 0.6 else f"g{rng.randrange(5)}", i, rng.randrange(4)) for i in range(2000)]


@pytest.mark.parametrize("block", [50, 1_000_000])
def test_number_rows(spark, rows, block):
    df = spark.createDataFrame(rows, "run string, seq long, id long")
    found = {(r["run"], r["seq"]): r["n"] for r in number_rows(df, ["run"], [block_of("seq", block)], ["seq"], "n").collect()}
    count = {}
    for run, seq, _ in sorted(rows, key=lambda r: r[1]):
        assert found[run, seq] == count.setdefault(run, 0)
        count[run] += 1


def test_number_rows_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 0), (None, 1), ("a", 2)], "run string, seq long")
    found = {(r["run"], r["seq"]): r["n"] for r in number_rows(df, ["run"], [block_of("seq", 1)], ["seq"], "n").collect()}
    assert found == {(None, 0): 0, (None, 1): 1, ("a", 2): 0}


@pytest.mark.parametrize("block", [50, 1_000_000])
def test_occurrence(spark, rows, block):
    df = spark.createDataFrame(rows, "run string, seq long, id long")
    found = {(r["run"], r["seq"]): r["occ"] for r in with_occurrence(df, ["run"], ["id"], "seq", block).collect()}
    count = {}
    for run, seq, key in sorted(rows, key=lambda r: r[1]):
        count[run, key] = count.get((run, key), 0) + 1
        assert found[run, seq] == count[run, key]


@pytest.mark.parametrize("block", [50, 1_000_000])
def test_running_max(spark, rows, block):
    df = spark.createDataFrame(rows, "run string, seq long, id long")
    value = F.when(F.col("id") == 0, F.col("seq"))
    found = {(r["run"], r["seq"]): r["m"] for r in running_max(df, ["run"], "seq", value, "m", block).collect()}
    last = {}
    for run, seq, key in sorted(rows, key=lambda r: r[1]):
        if key == 0:
            last[run] = seq
        assert found[run, seq] == last.get(run)


@pytest.mark.parametrize(
    "ids, expected",
    [
        ([1, 1, 1, 2, 2], [1, 1.01, 1.02, 2, 2.01]),
        ([1, 2, 1, 2], [1, 2, 1.01, 2.02]),
        ([1, 2, 1, 3, 2], [1, 2, 1.01, 3, 2.01]),
    ],
)
@pytest.mark.parametrize("block", [2, 1_000_000])
def test_nonduplicate_id(spark, ids, expected, block):
    df = spark.createDataFrame([("r", i, x) for i, x in enumerate(ids)], "run string, seq long, id long")
    found = [r["unique_id"] for r in sel.nonduplicate_id(df, block_rows=block).orderBy("seq").collect()]
    assert found == pytest.approx(expected)


def test_truncate_counts_rows_not_positions(spark):
    rows = [("r", "M1", s) for s in (3, 10, 11, 40)]
    df = spark.createDataFrame(rows, "run string, tel string, seq long")
    assert sorted(r["seq"] for r in sel.truncate_events(df, 3).collect()) == [3, 10, 11]
