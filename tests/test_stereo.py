import pytest

from duoscope.operators import stereo as st
from duoscope.plans.preprocess import preprocess

SCHEMA = (
    "run string, tel string, seq long, nanotime double, time2 double, id long, energy double,"
    " zd double, az double, pix array<float>"
)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def row(tel, seq, nano, ident, pix, energy=1.0, zd=20.0):
    return ("r", tel, seq, nano, 0.0, ident, energy, zd, 90.0, pix)


def test_interleaved_key_join(spark):
    m1 = frame(spark, [row("M1", 0, 1.0, 1, [1.0, 3.0]), row("M1", 1, 2.0, 2, [5.0, 7.0]), row("M1", 2, 3.0, 3, [0.0, 0.0])])
    m2 = frame(spark, [row("M2", 0, 2.0, 2, [6.0, 8.0], zd=30.0), row("M2", 1, 1.0, 1, [2.0, 4.0]), row("M2", 2, 9.0, 3, [0.0, 0.0])])
    rows = st.stereo_join(m1, m2, "time").rows.orderBy("id").collect()
    assert [(r["id"], r["pix"], r["zd"]) for r in rows] == [(1, [1.0, 2.0, 3.0, 4.0], 20.0), (2, [5.0, 6.0, 7.0, 8.0], 20.0)]
    other = st.stereo_join(m1, m2, "time", keys_from="M2").rows.orderBy("id").collect()
    assert [(r["id"], r["pix"], r["zd"]) for r in other] == [(1, [1.0, 2.0, 3.0, 4.0], 20.0), (2, [5.0, 6.0, 7.0, 8.0], 30.0)]


def test_nan_keys_never_join(spark):
    nan = float("nan")
    m1 = frame(spark, [row("M1", 0, nan, 1, [1.0])])
    m2 = frame(spark, [row("M2", 0, nan, 1, [1.0])])
    assert st.stereo_join(m1, m2, "time").rows.count() == 0


def test_simulated_key_join(spark):
    m1 = frame(spark, [row("M1", 0, 1.0, 1, [1.0], energy=5.0), row("M1", 1, 1.0, 1, [2.0], energy=6.0)])
    m2 = frame(spark, [row("M2", 0, 1.0, 1, [9.0], energy=6.0)])
    rows = st.stereo_join(m1, m2, "mc", keys_from="M2").rows.collect()
    assert [(r["energy"], r["pix"]) for r in rows] == [(6.0, [2.0, 9.0])]


def test_repeated_keys_are_refused(spark):
    m1 = frame(spark, [row("M1", i, 1.0, 1, [1.0]) for i in range(3)])
    m2 = frame(spark, [row("M2", i, 1.0, 1, [1.0]) for i in range(3)])
    growth = st.key_growth(m1, m2, ["nanotime", "time2", "id"]).first()
    assert (growth["n_1"], growth["n_2"], growth["n_joined"], growth["ok"]) == (3, 3, 9, False)
    clean = row("M1", 9, 2.0, 2, [1.0])
    m1 = m1.unionByName(frame(spark, [("s", *clean[1:]), ("t", *clean[1:])]))
    m2 = m2.unionByName(frame(spark, [("s", "M2", *clean[2:])]))
    joined = st.stereo_join(m1, m2, "time")
    assert [r["run"] for r in joined.rows.collect()] == ["s"]
    assert {r["run"]: r["status"] for r in joined.status.collect()} == {
        "r": "repeated_keys", "s": "ok", "t": "missing_partner"
    }


def test_repeats_cannot_hide_behind_lonely_events(spark):
    """The join is no longer than either telescope, and yet two of its rows would be wrong pairs."""
    m1 = frame(spark, [row("M1", i, float(k), k, [float(i)]) for i, k in enumerate([7, 7, 1, 2, 3])])
    m2 = frame(spark, [row("M2", i, float(k), k, [float(i)]) for i, k in enumerate([7, 7, 4, 5, 3])])
    keys = ["nanotime", "time2", "id"]
    assert st.key_growth(m1, m2, keys).first()["ok"]
    joined = st.stereo_join(m1, m2, "time")
    assert joined.rows.count() == 0
    status = joined.status.first()
    assert (status["status"], status["n_repeated"]) == ("repeated_keys", 1)
    assert [(r["id"], r["n_1"], r["n_2"]) for r in joined.repeated.collect()] == [(7, 2, 2)]
    others = st.stereo_join(m1, m2, "time", quarantine="keys")
    assert [r["id"] for r in others.rows.collect()] == [3]
    assert others.status.first()["status"] == "keys_held_back"
    one_side = st.stereo_join(m1, m2.filter("seq <> 1"), "time")
    assert one_side.rows.count() == 0 and one_side.status.first()["status"] == "repeated_keys"
    with pytest.raises(ValueError):
        st.stereo_join(m1, m2, "time", quarantine="none")


def test_rows_of_different_events_never_pair(spark):
    """Without row 1 of M2, every later position would meet another event."""
    m1 = [row("M1", i, float(i), i, [float(i)]) for i in range(5)]
    m2 = [row("M2", i, float(i), i, [float(i)]) for i in range(5) if i != 1]
    same = [("s", t, i, 1.0, 0.0, 1, 1.0, 20.0, 90.0, [1.0]) for t in ("M1", "M2") for i in range(2)]
    last = [("u", t, i, 1.0, 0.0, 1, 1.0, 20.0, 90.0, [float(i) if t == "M2" else 1.0]) for t in ("M1", "M2") for i in range(2)]
    alone = [("v", "M2", 0, 1.0, 0.0, 1, 1.0, 20.0, 90.0, [1.0])]
    events = frame(spark, m1 + m2 + same + last + alone)
    places = st.positions(events)
    status = {r["run"]: r["status"] for r in st.position_status(events, places).collect()}
    assert status == {"r": "length_differs", "s": "ok", "u": "tails_differ", "v": "missing_partner"}
    done = preprocess("data", events, normalize=None)
    assert {r["run"] for r in done.stereo.collect()} == {"s"}
    assert {r["run"]: r["status"] for r in done.status.collect()} == status
    placed = st.attach_position(events, places)
    joined = st.stereo_join(placed.filter("tel = 'M1'"), placed.filter("tel = 'M2'"), "position")
    assert {r["run"] for r in joined.rows.collect()} == {"s"}
    assert {r["run"]: r["status"] for r in joined.status.collect()} == status


def test_position_join_keeps_repeated_rows(spark):
    m1 = [row("M1", 2 * i, 1.0, 7, [1.0]) for i in range(3)]
    m2 = [row("M2", 5 * i, 2.0, 8, [2.0]) for i in range(3)]
    events = frame(spark, m1 + m2)
    places = st.positions(events)
    assert sorted(tuple(r) for r in places.select("tel", "sseq", "seq").collect()) == [
        *[("M1", i, 2 * i) for i in range(3)],
        *[("M2", i, 5 * i) for i in range(3)],
    ]
    for owner, ident, nano in (("M1", 7, 1.0), ("M2", 8, 2.0)):
        late = st.stereo_of_kept(events, places, owner)
        placed = st.attach_position(events, places)
        early = st.stereo_join(placed.filter("tel = 'M1'"), placed.filter("tel = 'M2'"), "position", owner).rows
        for rows in (late.collect(), early.collect()):
            assert sorted(r["sseq"] for r in rows) == [0, 1, 2]
            assert {(r["id"], r["nanotime"]) for r in rows} == {(ident, nano)}
            assert {tuple(r["pix"]) for r in rows} == {(1.0, 2.0)}


def test_unknown_options(spark):
    empty = frame(spark, [])
    with pytest.raises(ValueError):
        st.stereo_join(empty, empty, "nearest")
    with pytest.raises(ValueError):
        st.stereo_join(empty, empty, "time", keys_from="M3")


def test_a_row_kept_twice_stays_twice(spark):
    events = frame(spark, [row(t, i, float(i), i, [float(i)]) for t in ("M1", "M2") for i in range(3)])
    kept = spark.createDataFrame(
        [("r", t, s, q) for t in ("M1", "M2") for s, q in ((0, 0), (1, 2), (2, 2))],
        "run string, tel string, sseq long, seq long",
    )
    assert st.attach_position(events, kept).count() == 6
    rows = st.stereo_of_kept(events, kept).orderBy("sseq").collect()
    assert [(r["sseq"], r["id"], r["pix"]) for r in rows] == [(0, 0, [0.0, 0.0]), (1, 2, [2.0, 2.0]), (2, 2, [2.0, 2.0])]


def test_tail_duplicate(spark):
    same = [row(t, i, 1.0 if i else 0.0, 1, [1.0]) for t in ("M1", "M2") for i in range(3)]
    differ = [row("M1", i, 1.0, 1, [1.0]) for i in range(2)] + [row("M2", i, 1.0, 1, [float(i)]) for i in range(2)]
    columns = ["nanotime", "time2", "id", "pix"]
    good = st.tail_duplicate(frame(spark, same), columns, "seq").first()
    bad = st.tail_duplicate(frame(spark, differ), columns, "seq").first()
    assert (good["tail_dup_1"], good["tail_dup_2"], good["agree"]) == (True, True, True)
    assert (bad["tail_dup_1"], bad["tail_dup_2"], bad["agree"]) == (True, False, False)


def test_duplicate_count(spark):
    rows = [row("M1", i, 1.0, 1, [1.0, 2.0]) for i in range(4)] + [row("M1", 9, 1.0, 1, [1.0, 3.0])]
    found = st.duplicate_count(frame(spark, rows), ["nanotime", "time2", "id", "pix"]).first()
    assert (found["n_rows"], found["n_duplicates"]) == (5, 3)


def test_join_growth(spark):
    a = spark.createDataFrame([("r",)] * 3 + [("s",)], "run string")
    b = spark.createDataFrame([("r",)] * 2, "run string")
    found = {r["run"]: r for r in st.join_growth(a, b, a).collect()}
    assert found["r"]["ok"] and found["s"]["n_2"] == 0 and found["s"]["ok"]
    longer = {r["run"]: r["ok"] for r in st.join_growth(a, b, a.union(a)).collect()}
    assert longer == {"r": False, "s": False}
    exact = {r["run"]: r["ok"] for r in st.join_growth(a, b, b, exact=True).collect()}
    assert exact == {"r": False, "s": False}


def test_widths(spark):
    good = frame(spark, [row("M1", 0, 1.0, 1, [1.0]), row("M2", 0, 1.0, 1, [1.0])])
    bad = frame(spark, [row("M1", 0, 1.0, 1, [1.0]), row("M2", 0, 1.0, 1, [1.0, 2.0])])
    assert st.width_mismatch(good).first()["ok"]
    found = st.width_mismatch(bad).first()
    assert (found["width_1"], found["width_2"], found["ok"]) == (1, 2, False)


def test_pairs_and_status(spark):
    m1 = frame(spark, [row("M1", i, 1.0, i, [1.0]) for i in range(3)])
    m2 = frame(spark, [row("M2", i, 1.0, 1, [1.0]) for i in range(2)])
    found = st.pair_with_indicator(m1, m2).first()
    assert (found["n_both"], found["n_left_only"]) == (2, 2)
    flagged = st.match_status(m1.select("run", "id"), m2.select("run", "id"), ["run", "id"])
    assert {r["id"]: r["in_star"] for r in flagged.collect()} == {0: False, 1: True, 2: False}
    assert flagged.count() == 3
