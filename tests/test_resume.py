import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from duoscope.plans import resume
from duoscope.plans.preprocess import preprocess
from duoscope.plans.resume import Preparation
from duoscope.sources import events as ev
from duoscope.sources.shared import written

WIDTH = 4


def total(n):
    def make():
        return lambda x: np.asarray(x).reshape(-1, n).mean(axis=1)

    return make


@pytest.fixture(scope="module")
def inputs(spark):
    """Three runs; in the second a stereo row has no partner in M2."""
    rows, keys, valid = [], [], []
    for number, run in enumerate(("01", "02", "03")):
        for sub in ("001", "002"):
            valid.append((run, sub))
            for tel in ("M1", "M2"):
                for i in range(6):
                    seq = i + 6 * (sub == "002")
                    if run == "02" and tel == "M2" and seq == 4:
                        continue
                    pix = [float(number + seq + k + (tel == "M2")) for k in range(WIDTH)]
                    rows.append((f"2024_{tel}_{run}.{sub}_Y_x.csv", run, sub, tel, seq, float(seq), 1.0, seq, 20.0, 90.0, pix))
        keys += [(run, s, tel, float(seq), 1.0, seq) for s, seq in enumerate((1, 4, 7, 9)) for tel in ("M1", "M2")]
    schema = "name string, run string, subrun string, tel string, seq long, nanotime double, time2 double, id long, zd double, az double, pix array<float>"
    events = written(spark.createDataFrame(rows, schema), "resume-events")
    stereo = written(spark.createDataFrame(keys, "run string, sseq long, tel string, nanotime double, time2 double, id long"), "resume-keys")
    norm = spark.createDataFrame([(i, 1.0, 2.0) for i in range(2 * WIDTH + 3)], "pos int, mean double, std double")
    return events, stereo, spark.createDataFrame(valid, "run string, subrun string"), written(norm, "resume-norm")


def energies_of(rows):
    return sorted((r["run"], r["sseq"], r["id"], round(r["dl"], 9)) for r in rows.collect())


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def test_stops_after_each_stage_change_nothing(spark, folder, inputs, monkeypatch):
    events, stereo, valid, norm = inputs
    options = {"make_predict_fn": total(2 * WIDTH), "n_features": 2 * WIDTH}
    whole = preprocess("data", events, stereo, valid, norm, **options)
    want = energies_of(whole.energies)
    assert {r[0] for r in want} == {"01", "03"}
    prep = Preparation(spark, f"{folder}/out")
    commit, left = resume.Manifest.commit, []

    def dies(self, stage, rows):
        if stage in left:
            left.remove(stage)
            raise OSError("lost between data and manifest")
        commit(self, stage, rows)

    monkeypatch.setattr(resume.Manifest, "commit", dies)
    for stage in resume.STAGES[1:]:
        left.append(stage)
        with pytest.raises(OSError):
            prep.run(stereo, norm, events, valid=valid, until=stage, **options)
        prep.run(stereo, norm, events, valid=valid, until=stage, **options)
    assert energies_of(prep.table("energies")) == want
    assert {r["run"]: r["status"] for r in prep.manifest.done("selected").collect()} == {"01": "ok", "02": "mismatch", "03": "ok"}
    before = files(f"{folder}/out")
    prep.run(stereo, norm, events, valid=valid, **options)
    assert files(f"{folder}/out") == before
    lines = spark.read.text(f"{folder}/out/lines/impute").groupBy("run").count().collect()
    assert {r["run"]: r["count"] for r in lines} == {1: 4, 3: 4}


def test_later_runs_leave_the_earlier_alone(spark, folder, inputs):
    events, stereo, valid, norm = inputs
    options = {"make_predict_fn": total(2 * WIDTH), "n_features": 2 * WIDTH}
    prep = Preparation(spark, f"{folder}/out")
    lacking = events.filter("not (run = '03' and tel = 'M2' and subrun = '002')")
    prep.run(stereo, norm, lacking, valid=valid, **options)
    assert {r["run"] for r in prep.manifest.done("selected").collect()} == {"01", "02"}
    first = files(f"{folder}/out")
    prep.run(stereo, norm, events, valid=valid, **options)
    after = files(f"{folder}/out")
    assert all(after[f] == at for f, at in first.items())
    want = energies_of(preprocess("data", events, stereo, valid, norm, **options).energies)
    assert energies_of(prep.table("energies")) == want


def test_text_files_are_converted_once(spark, folder, inputs):
    events, stereo, valid, norm = inputs
    lines = ev.calib_lines(events.orderBy("name", "seq"))
    lines.repartition(1).sortWithinPartitions("name").write.partitionBy("name").text(f"{folder}/text")
    prep = Preparation(spark, f"{folder}/out")
    only = valid.filter("run <> '02'")
    prep.run(stereo, norm, text=f"{folder}/text", valid=only, until="converted")
    assert {r["run"]: r["n_rows"] for r in prep.manifest.done("converted").collect()} == {"01": 24, "03": 24}
    before = files(f"{folder}/out")
    prep.run(stereo, norm, text=f"{folder}/text", valid=only, until="converted")
    assert files(f"{folder}/out") == before
    late = Preparation(spark, f"{folder}/late")
    late.run(stereo, norm, text=f"{folder}/text", until="converted", first_file=7)
    assert late.table("converted").select("name").distinct().count() == 6
    assert [tuple(r) for r in late.batches(f"{folder}/text").collect()] == [("2024", 12, 3)]
    day = Preparation(spark, f"{folder}/day")
    with pytest.raises(FileNotFoundError):
        day.run(stereo, norm, text=f"{folder}/nowhere", until="converted", batch="2024")
    day.run(stereo, norm, text=f"{folder}/text", until="converted", batch="2023")
    assert day.manifest.done("converted").count() == 0
    day.run(stereo, norm, text=f"{folder}/text", until="converted", batch="2024")
    assert day.manifest.done("converted").count() == 3
    for call in ({"until": "nowhere", "events": events}, {}):
        with pytest.raises(ValueError):
            late.run(stereo, norm, **call)
