"""Streams that go on: a changing registry, passages that merge, previous rentals that come late."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ferrolith.plans import access
from ferrolith.streaming import live

READ = "id long, timestamp timestamp_ntz, plate_number string, detection_confidence double"
CHANGE = "seq long, timestamp timestamp_ntz, plaque string, marque string, nom string, acces string, op string"
DAY = datetime(2024, 1, 1)


def at(minutes):
    return DAY + timedelta(minutes=minutes)


@pytest.fixture
def feed(spark, tmp_path):
    """Two folders of landed rows and one run over what is new in both."""
    def put(name, schema, rows):
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    def source(name, schema):
        (tmp_path / name).mkdir(exist_ok=True)
        return spark.readStream.schema(schema).parquet(str(tmp_path / name))

    return put, source, lambda stream: live.run_to_folder(stream, "t", str(tmp_path / "out"), str(tmp_path / "state"))


def test_registry_changes_between_batches(feed):
    put, source, run = feed

    def decided(reads, changes):
        put("reads", READ, [(i, at(m), p, 0.9) for i, m, p in reads])
        put("changes", CHANGE, [(k, at(m), p, "b", f"name {p}", a, op) for k, m, p, a, op in changes])
        log = run(live.live_decisions(source("reads", READ), source("changes", CHANGE), "id"))
        return {r["id"]: (r["resultat"], r["resident_name"]) for r in log.collect()}

    log = decided([(1, 10, "AB-123"), (2, 20, "ab 123"), (3, 5, "zz"), (4, 12, " ")], [(0, 15, "AB123", "oui", "add")])
    assert log == {1: ("REFUSED", None), 2: ("AUTHORISED", "name AB123"), 3: ("REFUSED", None)}
    # added and removed between the batches; the second add of a plate that is there is rejected
    log = decided([(5, 40, "ZZ"), (6, 45, "AB123"), (7, 41, "AB123")], [(1, 30, "z z", "oui", "add"), (2, 31, "zz", "non", "add"), (3, 42, "AB-123", None, "delete")])
    assert log[5] == ("AUTHORISED", "name z z") and log[6] == ("REFUSED", None) and log[7] == ("AUTHORISED", "name AB123")
    # a late read finds what held at its time; a change of the read's moment counts; toggles of a gone plate do nothing
    log = decided([(8, 16, "AB123"), (9, 50, "ZZ"), (10, 51, "ZZ"), (11, 60, "AB123")], [(4, 50, "ZZ", None, "toggle"), (5, 51, "ZZ", None, "toggle"), (6, 55, "AB123", None, "toggle")])
    assert log[8][0] == "AUTHORISED" and log[9][0] == "REFUSED" and log[10][0] == "AUTHORISED" and log[11] == ("REFUSED", None)
    # started again without anything new, the log is the same
    assert decided([], []) == log and sorted(log) == [1, 2, 3, 5, 6, 7, 8, 9, 10, 11]


def test_registry_state_is_bounded(spark, feed, tmp_path):
    put, source, run = feed
    for day in range(4):
        put("changes", CHANGE, [(k, at(day * 1440 + k), "AB1", "b", "n", None, "toggle") for k in range(day == 0, 50)] + (
            [(0, at(-1), "AB1", "b", "n", "oui", "add")] if day == 0 else []))
        put("reads", READ, [(day, at(day * 1440 + 100), "AB1", 0.9)])
        run(live.live_decisions(source("reads", READ), source("changes", CHANGE), "id", keep="1 hour"))
    state = spark.read.format("statestore").load(str(tmp_path / "state"))
    kept = state.select(F.size("value.groupState.at").alias("n")).agg(F.max("n")).first()[0]
    assert kept <= 51
    log = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert [r["resultat"] for r in log] == ["REFUSED", "REFUSED", "REFUSED", "REFUSED"]  # 49, 99, 149, 199 switches


def test_passage_across_a_slot(spark, feed):
    put, source, run = feed
    schema = "user_id long, event_id long, ts timestamp_ntz"
    minutes = [3, 4.9, 5.1, 9, 14, 20, 25, 31, 90, 200]  # 9 and 14 lie exactly five minutes apart
    rows = [(1, i, at(m)) for i, m in enumerate(minutes)] + [(2, 100, at(0))]
    put("reads", schema, rows)
    got = run(live.passages(source("reads", schema).select("user_id", "ts"), "user_id", "ts")).collect()
    batch = access.passages(spark.createDataFrame(rows, schema), "user_id", "ts", "event_id").collect()
    assert sorted((r["user_id"], r["ts"]) for r in batch) == [(1, at(m)) for m in (3, 20, 31, 90, 200)] + [(2, at(0))]
    # the last passage is not over yet
    assert sorted((r["user_id"], r["first_seen"]) for r in got) == sorted((r["user_id"], r["ts"]) for r in batch if r["ts"] != at(200))
    assert {r["first_seen"]: r["reads"] for r in got if r["user_id"] == 1} == {at(3): 5, at(20): 2, at(31): 1, at(90): 1}


def test_late_read_joins_two_passages(feed):
    put, source, run = feed
    schema = "user_id long, ts timestamp_ntz"
    stream = lambda: live.passages(source("reads", schema), "user_id", "ts")
    put("reads", schema, [(1, at(0)), (1, at(8))])
    assert run(stream()).count() == 0
    put("reads", schema, [(1, at(4)), (1, at(60))])
    assert [(r["first_seen"], r["last_seen"], r["reads"]) for r in run(stream()).collect()] == [(at(0), at(8), 3)]


def test_previous_rental_may_come_later(spark, feed, tmp_path):
    put, source, run = feed
    schema = "id long, previous long, gap double, ts timestamp_ntz"
    done = "id long, delay double, ts timestamp_ntz"

    def alerts(rentals, ended):
        put("rentals", schema, [(i, p, g, at(m)) for i, p, g, m in rentals])
        put("ended", done, [(i, d, at(m)) for i, d, m in ended])
        rows = run(live.late_alerts(source("rentals", schema), source("ended", done), "id", "previous", "delay", "gap", "ts", within="2 hours")).collect()
        return {r["id"]: (r["prev_delay"], r["is_problem"]) for r in rows}

    assert alerts([(1, 10, 30.0, 100), (2, 20, 30.0, 100), (3, 30, 30.0, 100), (4, None, 30.0, 100), (5, 10, None, 100)], [(20, 45.0, 90)]) == {2: (45.0, True)}
    # the previous rental arrives after the one it delays
    assert alerts([], [(10, 31.0, 110)]) == {2: (45.0, True), 1: (31.0, True)}
    # once its time is over, a rental whose previous one never came is returned without a delay, and leaves the state
    found = alerts([(6, 60, 5.0, 1000)], [(50, 1.0, 1000)])
    assert {i: found[i] for i in (1, 2, 3)} == {1: (31.0, True), 2: (45.0, True), 3: (None, False)} and set(found) == {1, 2, 3}
    state = spark.read.format("statestore").option("joinSide", "left").load(str(tmp_path / "state"))
    assert state.count() == 1


def test_plates_share_states(spark, feed, tmp_path, monkeypatch):
    monkeypatch.setattr(live, "GROUPS", 2)
    put, source, run = feed
    plates = [f"P{k}" for k in range(20)]
    stream = lambda: live.live_decisions(source("reads", READ), source("changes", CHANGE), "id", keep="1 hour")
    put("changes", CHANGE, [(k, at(k % 3), p, "b", f"name {p}", "oui", "add") for k, p in enumerate(plates)])
    put("reads", READ, [(k, at(5), p, 0.9) for k, p in enumerate(plates)])
    assert {(r["normalized_plate"], r["resultat"], r["resident_name"]) for r in run(stream()).collect()} == {(p, "AUTHORISED", f"name {p}") for p in plates}
    # one plate moves on; the others in its group keep what they had
    put("changes", CHANGE, [(50 + k, at(10 + k), "P3", None, None, None, "toggle") for k in range(3)])
    put("reads", READ, [(100 + k, at(300), p, 0.9) for k, p in enumerate(plates)])
    late = {r["normalized_plate"]: r["resultat"] for r in run(stream()).filter("id >= 100").collect()}
    assert late == {p: "REFUSED" if p == "P3" else "AUTHORISED" for p in plates}
    assert spark.read.format("statestore").load(str(tmp_path / "state")).count() <= 2 * live.SHARES
