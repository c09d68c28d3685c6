import random

import pytest

from duoscope.operators import matching
from duoscope.operators import selection as sel
from duoscope.operators.matching import match_events

KEYS = ("id",)
SCHEMA = "run string, tel string, {n} long, id double"


def walk_model(calib, stereo):
    """Plain two-pointer walk with tail repair: (status, kept calibrated positions)."""
    if len(calib) < len(stereo):
        return "calib_shorter", []
    kept = []
    for i, key in enumerate(calib):
        if len(kept) == len(stereo):
            break
        if key == stereo[len(kept)]:
            kept.append(i)
    if not kept:
        return "empty", []
    if len(kept) == len(stereo):
        return "ok", kept
    if len(kept) == len(stereo) - 1 and stereo[-1] == stereo[-2]:
        return "tail_dup", kept + [kept[-1]]
    return "mismatch", []


def run_match(spark, cases, block_rows, repair_tail=True):
    """cases: {run: (calib keys, stereo keys)}; returns {run: (status, kept)}."""
    calib = [(r, "M1", i, k) for r, (c, _) in cases.items() for i, k in enumerate(c)]
    stereo = [(r, "M1", i, k) for r, (_, s) in cases.items() for i, k in enumerate(s)]
    found = match_events(
        spark.createDataFrame(calib, SCHEMA.format(n="seq")),
        spark.createDataFrame(stereo, SCHEMA.format(n="sseq")),
        KEYS,
        repair_tail,
        block_rows,
    )
    status = {r["run"]: r["status"] for r in found.status.collect()}
    kept = {}
    for row in found.kept.orderBy("run", "sseq").collect():
        kept.setdefault(row["run"], []).append(row["seq"])
    return {run: (status[run], kept.get(run, [])) for run in cases}


A, B, C, D, Z = 1.0, 2.0, 3.0, 4.0, 9.0
NAN = float("nan")
EDGES = {
    "walk": (([A, B, A], [B, A]), ("ok", [1, 2])),
    "stuck": (([A, C, D], [A, B, C]), ("mismatch", [])),
    "short": (([A, Z], [A, Z, Z]), ("calib_shorter", [])),
    "tail": (([A, B, Z], [A, Z, Z]), ("tail_dup", [0, 2, 2])),
    "tail_walk": (([A, B, A, Z], [B, A, Z, Z]), ("tail_dup", [1, 2, 3, 3])),
    "none": (([A, B], [Z]), ("empty", [])),
    "nan": (([A, NAN, B], [A, NAN]), ("mismatch", [])),
    "nan_tail": (([A, NAN, B], [A, NAN, NAN]), ("mismatch", [])),
    "negative_zero": (([0.0, A], [-0.0, A]), ("ok", [0, 1])),
    "order": (([A, B], [B, A]), ("mismatch", [])),
    "all": (([A, A, A], [A, A, A]), ("ok", [0, 1, 2])),
}


@pytest.mark.parametrize("block_rows", [1_000_000, 2])
def test_edge_rows(spark, block_rows):
    cases = {name: case for name, (case, _) in EDGES.items()}
    found = run_match(spark, cases, block_rows)
    for name, (_, expected) in EDGES.items():
        assert found[name] == expected, name


def test_without_repair(spark):
    found = run_match(spark, {"tail": ([A, B, Z], [A, Z, Z])}, 10, repair_tail=False)
    assert found["tail"] == ("mismatch", [])


@pytest.mark.parametrize("block_rows, seed", [(1_000_000, 1), (3, 2), (7, 3)])
def test_random_runs_agree_with_the_walk(spark, block_rows, seed):
    """Few keys force repeats in mixed order; several blocks force the long way."""
    rng = random.Random(seed)
    cases = {}
    for number in range(400):
        n_keys = rng.choice([1, 2, 3, 30])
        calib = [float(rng.randrange(n_keys)) for _ in range(rng.randrange(1, 30))]
        kind = rng.random()
        if kind < 0.6:
            stereo = [k for k in calib if rng.random() < 0.7]
        elif kind < 0.8:
            stereo = [k for k in calib if rng.random() < 0.6]
            stereo = stereo + stereo[-1:]
        else:
            stereo = [float(rng.randrange(n_keys)) for _ in range(rng.randrange(1, 20))]
        if stereo:
            cases[f"r{number:03d}"] = (calib, stereo)
    found = run_match(spark, cases, block_rows)
    statuses = set()
    for run, (calib, stereo) in cases.items():
        assert found[run] == walk_model(calib, stereo), (run, calib, stereo)
        statuses.add(found[run][0])
    assert {"ok", "tail_dup", "mismatch", "empty", "calib_shorter"} <= statuses


@pytest.mark.parametrize("block_rows, fan, wide", [(2, 2, 64), (4, 3, 1)])
def test_blocks_walked_at_once(spark, monkeypatch, block_rows, fan, wide):
    """Trees of several levels, bounds of several pieces, and runs that are too wide for them."""
    monkeypatch.setattr(matching, "FAN", fan)
    monkeypatch.setattr(matching, "WIDE", wide)
    rng = random.Random(block_rows)
    cases = {}
    for number in range(300):
        calib = [float(rng.randrange(rng.choice([1, 2, 5, 12]))) for _ in range(rng.randrange(1, 40))]
        stereo = [k for k in calib if rng.random() < 0.7]
        if number % 3 == 0:
            stereo = stereo + stereo[-1:]
        if number % 5 == 0 and len(stereo) > 3:
            at = rng.randrange(len(stereo) - 1)
            stereo[at], stereo[at + 1] = stereo[at + 1], stereo[at]
        if stereo:
            cases[f"r{number:03d}"] = (calib, stereo)
    found = run_match(spark, cases, block_rows)
    for run, (calib, stereo) in cases.items():
        assert found[run] == walk_model(calib, stereo), (run, calib, stereo)


def test_steps_do_not_grow_with_the_run(spark, monkeypatch):
    """A run of 64 blocks that must be walked, its keys repeated in mixed order."""
    rng = random.Random(1)
    calib = [float(rng.randrange(60)) for _ in range(6400)]
    stereo = [k for k in calib if rng.random() < 0.7]
    steps = {}
    store = matching.written
    for block_rows in (800, 100):
        labels = []
        monkeypatch.setattr(matching, "written", lambda df, label: labels.append(label) or store(df, label))
        monkeypatch.setattr(matching, "listed", lambda df, label: labels.append(label) or store(df, label))
        assert run_match(spark, {"long": (calib, stereo)}, block_rows)["long"] == walk_model(calib, stereo)
        steps[block_rows] = labels
    assert "walk-open" in steps[100] and len(steps[100]) <= 12 and steps[100] == steps[800]


def test_one_run_with_most_rows(spark):
    """A run far longer than a block, with one key on a third of its rows."""
    rng = random.Random(5)
    calib = [7.0 if rng.random() < 0.33 else float(100 + i) for i in range(5000)]
    stereo = [k for k in calib if rng.random() < 0.8]
    found = run_match(spark, {"long": (calib, stereo), "small": ([A, B], [A, B])}, 500)
    assert found["long"] == walk_model(calib, stereo)
    assert found["small"] == ("ok", [0, 1])


def selected(spark, calib, stereo, valid):
    return sel.select_events(
        spark.createDataFrame(calib, "run string, subrun string, tel string, seq long, id double"),
        spark.createDataFrame(stereo, SCHEMA.format(n="sseq")),
        spark.createDataFrame(valid, "run string, subrun string"),
        KEYS,
    )


def test_whole_runs_are_accepted(spark):
    rows = []
    for tel in ("M1", "M2"):
        for run in ("good", "half", "gone"):
            rows += [(run, "001", tel, 0, A), (run, "002", tel, 1, B), (run, "003", tel, 2, C)]
    rows = [r for r in rows if not (r[0] == "half" and r[2] == "M2" and r[4] == B)]
    rows.append(("half", "002", "M2", 1, D))
    rows = [r for r in rows if not (r[0] == "gone" and r[2] == "M1" and r[1] == "002")]
    stereo = [(r, t, i, k) for r in ("good", "half", "gone") for t in ("M1", "M2") for i, k in enumerate([A, B])]
    valid = [(r, s) for r in ("good", "half", "gone") for s in ("001", "002")]
    found = selected(spark, rows, stereo, valid)
    status = {(r["run"], r["tel"]): r["status"] for r in found.status.collect()}
    assert status == {
        ("good", "M1"): "ok",
        ("good", "M2"): "ok",
        ("half", "M1"): "partner_failed",
        ("half", "M2"): "mismatch",
        ("gone", "M1"): "missing_files",
        ("gone", "M2"): "partner_failed",
    }
    assert {r["run"] for r in found.kept.collect()} == {"good"}
    assert found.kept.count() == 4
