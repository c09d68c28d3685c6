import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from duoscope.functions import arrays
from duoscope.operators import energy as en
from duoscope.operators import normalise as no
from duoscope.operators import statistics as stt
from duoscope.sources.tables import impute_value

INF, NAN = float("inf"), float("nan")


@pytest.fixture(scope="module")
def events(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(60):
        pix = rng.normal(5, 3, 8).astype("f4").tolist()
        pix[2] = 0.1
        rows.append(
            (f"r{i % 3}", i, float(np.exp(rng.normal())), float(rng.uniform(5, 50)), float(rng.uniform(0, 360)), pix)
        )
    return spark.createDataFrame(rows, "run string, id long, energy double, zd double, az double, pix array<float>")


def matrix(events, mc=True):
    rows = events.orderBy("id").collect()
    full = np.array([[*([math.log(r["energy"])] if mc else []), *r["pix"], r["zd"], r["az"]] for r in rows])
    return rows, full


def norm_of(df):
    rows = df.orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(len(rows)))
    return np.array([r["mean"] for r in rows]), np.array([r["std"] for r in rows])


def test_statistics_are_population_statistics(events):
    for mc in (True, False):
        mean, std = norm_of(stt.feature_stats(events, mc))
        _, full = matrix(events, mc)
        np.testing.assert_allclose(mean, full.mean(0), atol=1e-9)
        np.testing.assert_allclose(std, full.std(0), atol=1e-9)
    assert norm_of(stt.feature_stats(events, True))[1][3] == 0.0


def test_mean_of_file_statistics(events, spark):
    _, full = matrix(events, mc=False)
    parts = [full[np.arange(60) % 3 == k] for k in range(3)]
    mean, std = norm_of(stt.mean_of_file_stats(events, mc=False))
    np.testing.assert_allclose(mean, np.mean([p.mean(0) for p in parts], axis=0), atol=1e-9)
    np.testing.assert_allclose(std, np.mean([p.std(0) for p in parts], axis=0), atol=1e-9)
    mc_norm = spark.createDataFrame([(0, 7.0, 8.0), (1, 0.0, 0.0)], "pos int, mean double, std double")
    shifted, _ = norm_of(stt.mean_of_file_stats(events, mc=False, mc_norm=mc_norm))
    assert shifted[0] == 7.0 and shifted[1] == pytest.approx(mean[0])


def test_broken_files_do_not_spoil_the_mean(spark):
    rows = [("a", [1.0]), ("a", [3.0]), ("b", [NAN]), ("b", [1.0])]
    df = spark.createDataFrame(rows, "run string, pix array<float>").withColumns({"zd": F.lit(1.0), "az": F.lit(1.0)})
    mean, std = norm_of(stt.mean_of_file_stats(df, mc=False))
    assert (mean[0], std[0]) == (2.0, 1.0)
    assert math.isnan(norm_of(stt.feature_stats(df, mc=False))[0][0])


def test_scaled_simulation(events):
    rows, full = matrix(events)
    mean, std = full.mean(0), full.std(0)
    out = no.normalize_own(events).orderBy("id").collect()
    width = np.where(std < 1e-12, 1, std)
    expected = np.where(std < 1e-12, full, (full - mean) / width)
    np.testing.assert_allclose([r["pix"] for r in out], expected[:, 1:9], atol=1e-5)
    np.testing.assert_allclose([r["energy"] for r in out], expected[:, 0], atol=1e-9)
    assert [r["zd"] for r in out] == [r["zd"] for r in rows]


def test_scaled_observation_uses_the_shifted_norm(events):
    norm = stt.feature_stats(events, mc=True)
    rows, full = matrix(events, mc=False)
    mean, std = norm_of(norm)
    out = no.normalize_pixels(events.drop("energy"), norm, mc=False).orderBy("id").collect()
    scaled = (full[:, :8] - mean[1:9]) / np.where(std[1:9] == 0, 1, std[1:9])
    scaled[:, 2] = full[:, 2]
    np.testing.assert_allclose([r["pix"] for r in out], scaled, atol=1e-5)
    np.testing.assert_allclose([r["zd"] for r in out], (full[:, 8] - 45) / 26, atol=1e-9)
    np.testing.assert_allclose([r["az"] for r in out], (full[:, 9] - 180) / 105, atol=1e-9)
    skipped = no.normalize_pixels(events, norm, mc=False, skip_tail=3).orderBy("id").collect()
    np.testing.assert_allclose([r["pix"][5:] for r in skipped], full[:, 5:8], atol=1e-6)


@pytest.mark.parametrize("compat", [False, True])
def test_camera_wise(events, compat):
    rows, full = matrix(events)
    mean, std = full.mean(0), full.std(0)
    std[3] = 0.0
    channel = np.arange(8) % 4
    mu = np.array([mean[1:9][channel == c].sum() / 5 for c in range(4)])
    sd = np.array([std[1:9][channel == c].sum() / 5 for c in range(4)])
    use = np.zeros(8, int) if compat else channel
    expected = (full[:, 1:9] - mu[use]) / sd[use]
    expected[:, 2] = full[:, 3]
    out = no.normalize_camera(events, n_real=5, compat=compat).orderBy("id").collect()
    np.testing.assert_allclose([r["pix"] for r in out], expected, rtol=1e-4, atol=1e-4)
    np.testing.assert_allclose([r["az"] for r in out], (full[:, 10] - mean[10]) / std[10], atol=1e-9)


def test_log_and_finite(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (math.e,), (NAN,), (None,)], "e double")
    logs = [r[0] for r in df.select(arrays.log_energy(F.col("e"))).collect()]
    assert logs[0] == -INF and math.isnan(logs[1]) and logs[2] == 1.0 and math.isnan(logs[3])
    assert logs[4] is None
    capped = [r[0] for r in df.select(arrays.finite(arrays.log_energy(F.col("e")), 9.0)).collect()]
    assert capped[:4] == [-9.0, 0.0, 1.0, 0.0]
    pix = spark.createDataFrame([([NAN, INF, -INF, 2.0],)], "pix array<float>")
    assert pix.select(arrays.finite_array("pix", 5.0)).first()[0] == [0.0, 5.0, -5.0, 2.0]


def test_zero_energy_is_capped(spark, events):
    norm = stt.feature_stats(events, mc=True)
    odd = events.limit(1).withColumn("energy", F.lit(0.0))
    assert no.normalize_pixels(odd, norm, mc=True).first()["energy"] == -arrays.INF_CAP


def test_nan_report(spark):
    df = spark.createDataFrame([("a", [NAN, 1.0]), ("a", [NAN, NAN]), ("b", [1.0, 2.0])], "run string, pix array<float>")
    found = {r["run"]: (r["n_nan"], r["n_values"]) for r in stt.nan_report(df).collect()}
    assert found == {"a": (3, 4), "b": (0, 2)}


def test_exact_sample(spark):
    df = spark.range(20_000).select(F.lit("r").alias("run"), F.col("id"), (F.col("id") * 2).alias("x"))
    chosen = stt.sample_exact(df, 1000, seed=3, keys=("run", "id"))
    first = sorted(r["id"] for r in chosen.collect())
    assert len(first) == len(set(first)) == 1000
    again = stt.sample_exact(df.repartition(7), 1000, seed=3, keys=("run", "id"))
    assert sorted(r["id"] for r in again.collect()) == first
    other = sorted(r["id"] for r in stt.sample_exact(df, 1000, seed=4, keys=("run", "id")).collect())
    assert other != first
    assert abs(np.mean(first) - 10_000) < 1_000
    assert stt.sample_exact(df, 50_000, keys=("run", "id")).count() == 20_000
    ranks = df.select("id", F.xxhash64(F.lit(3), "run", "id").alias("h")).toPandas()
    assert sorted(ranks.nsmallest(1000, "h")["id"]) == first


@pytest.mark.parametrize("bits, ranked", [(16, 1000), (3, 4), (2, 0)])
def test_exact_sample_of_any_range(spark, monkeypatch, bits, ranked):
    """Ranges that are cut again and again end with the same rows; null keys and repeated rows count."""
    monkeypatch.setattr(stt, "SAMPLE_BITS", bits)
    monkeypatch.setattr(stt, "SAMPLE_RANKED", ranked)
    rows = [(None if i % 50 == 0 else f"r{i % 3}", i) for i in range(900)]
    df = spark.createDataFrame(rows, "run string, id long").repartition(5)
    hashes = df.select("id", F.xxhash64(F.lit(1), "run", "id").alias("h")).toPandas().sort_values("h")["id"].tolist()
    for n in (0, 1, 17, 450, 899, 900, 901):
        got = [r["id"] for r in stt.sample_exact(df, n, seed=1, keys=("run", "id")).collect()]
        assert sorted(got) == sorted(hashes[:n])
    assert stt.sample_exact(df.limit(0), 3, keys=("run", "id")).count() == 0


def test_energies_and_overflow(spark):
    norm = spark.createDataFrame([(0, 0.5, 1.0), (1, 9.0, 9.0)], "pos int, mean double, std double")
    df = spark.createDataFrame([(0, 0.5, 0.5), (1, 1000.0, -0.5)], "seq long, dl double, mc_truth double")
    rows = en.adjust_energy(df, norm).orderBy("seq").collect()
    assert rows[0]["dl"] == pytest.approx(math.e) and rows[0]["mc_truth"] == pytest.approx(math.e)
    assert rows[1]["dl"] == INF and rows[1]["mc_truth"] == 1.0
    zero = en.adjust_energy(df, norm).select("seq", impute_value(F.col("dl")).alias("x")).orderBy("seq").collect()
    assert zero[1]["x"] == 0.0
    assert en.adjust_many([df, df], norm).count() == 4


def test_energy_difference(spark):
    a = spark.createDataFrame([("r", 0, 1.0), ("r", 1, 2.0), ("s", 0, 1.0)], "run string, seq long, dl double")
    b = spark.createDataFrame([("r", 0, 1.0), ("r", 1, 2.02), ("r", 2, 9.0), ("s", 0, 1.0)], "run string, seq long, dl double")
    found = {r["run"]: r for r in en.energy_diff(a, b).collect()}
    assert (found["r"]["n_rows"], found["r"]["n_above"], found["r"]["close"], found["r"]["exact"]) == (2, 1, False, False)
    assert found["s"]["close"] and found["s"]["exact"] and found["r"]["n_only_original"] == 1
    more = en.energy_diff(b, a).filter("run = 'r'").first()
    assert (more["n_only_imputed"], more["close"], more["exact"]) == (1, False, False)


def test_scores_of_a_model(spark, events):
    def make():
        def predict(pix):
            return pix.astype("f8").sum(axis=1)

        return predict

    rows = en.score(events, make, 8).orderBy("id").collect()
    for r in rows:
        assert r["dl"] == pytest.approx(sum(r["pix"]), abs=1e-4)


def test_imputed_by_keys(spark):
    events = spark.createDataFrame([("r", 1.0, 2.0, 3), ("r", NAN, 2.0, 4)], "run string, nanotime double, time2 double, id long")
    energies = events.withColumn("dl", F.lit(8.0))
    rows = en.impute_energy(events, energies).rows.collect()
    assert sorted((r["id"], r["energy_est"]) for r in rows) == [(3, 8.0), (4, None)]
    twice = en.impute_energy(events, energies.unionByName(energies))
    assert sorted((r["id"], r["energy_est"]) for r in twice.rows.collect()) == [(3, None), (4, None)]
    found = twice.status.first()
    assert (found["n_events"], found["n_missing"], found["n_repeated"], found["ok"]) == (2, 1, 1, False)
