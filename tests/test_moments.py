import numpy as np
import pytest
from pyspark.sql import functions as F

from duoscope.operators import moments as mo
from duoscope.operators import statistics as stt

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def events(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        pix = (1e6 + rng.normal(size=6)).tolist()
        if i % 90 == 7:
            pix[2] = NAN
        rows.append((f"r{i % 5}", float(i + 1), 20.0 + i % 3, 90.0, pix))
    return spark.createDataFrame(rows, "run string, energy double, zd double, az double, pix array<float>").repartition(7)


def numbers(norm):
    return {r["pos"]: (r["mean"], r["std"]) for r in norm.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for pos in a:
        assert a[pos] == pytest.approx(b[pos], rel=1e-9, nan_ok=True), pos


@pytest.mark.parametrize("fan_in, folded", [(32, 1 << 20), (2, 8)])
def test_norms_from_states(spark, events, folder, monkeypatch, fan_in, folded):
    monkeypatch.setattr(mo, "FAN_IN", fan_in)
    monkeypatch.setattr(mo, "FOLDED", folded)
    want, per_run = numbers(stt.feature_stats(events, mc=True)), numbers(stt.mean_of_file_stats(events, mc=True))
    for part in ("run in ('r0', 'r1')", "run = 'r2'", "run in ('r3', 'r4')"):
        states = mo.add_runs(events.filter(part), f"{folder}/m", mc=True)
    assert states.count() == 5
    same(numbers(mo.norm_of(states)), want)
    same(numbers(mo.mean_of_runs(states, mc=True)), per_run)
    # A run that comes again replaces its state.
    again = mo.add_runs(events.filter("run = 'r2'"), f"{folder}/m", mc=True)
    same(numbers(mo.norm_of(again)), want)
    only = numbers(mo.norm_of(again.filter("run = 'r1'")))
    same(only, numbers(stt.feature_stats(events.filter("run = 'r1'"), mc=True)))


def test_states_of_odd_rows(spark, folder):
    rows = [("a", [1.0, 2.0, None]), ("a", [3.0]), ("a", []), (None, [5.0, INF]), ("b", [NAN])]
    df = spark.createDataFrame(rows, "run string, pix array<float>").withColumns({"zd": F.lit(1.0), "az": F.lit(None).cast("double")})
    states = {r["run"]: r for r in mo.run_moments(df, mc=False, most_runs=0).collect()}
    assert states.keys() == {"a", "b", None}
    # Positions 0 to 2 and the pointing: the row of one feature has its angles at 1 and 2.
    assert states["a"]["n"] == [3, 2, 0, 1, 0]
    want = numbers(stt.feature_stats(df, mc=False).filter("mean is not null"))
    same(numbers(mo.norm_of(mo.run_moments(df, mc=False))), want)
    assert mo.norm_of(mo.run_moments(df.limit(0), mc=False)).count() == 0


def test_no_row_per_value(spark, events):
    rows = events.select("run", stt.feature_vector(events, True).alias("x"))
    fold = mo._folder(mo._merge, mo._of_values, mo._batch_of, mo.FOLDED, 256)
    plan = rows.mapInArrow(fold, f"{mo.STATE}, part long")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan.split("MapInArrow")[0]


def test_pairwise_merge_keeps_small_deviations():
    rng = np.random.default_rng(1)
    x = 1e9 + rng.normal(size=(10_000, 3))
    state = None
    for part in np.array_split(x, 77):
        new = mo._of_values((part, np.ones(part.shape, bool)))
        state = new if state is None else mo._merge(state, new)
    assert np.allclose(state[1], x.mean(axis=0), rtol=1e-14)
    assert np.allclose(np.sqrt(state[2] / state[0]), x.std(axis=0), rtol=1e-6)
