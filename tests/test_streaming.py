"""Streams of several batches: repeats, late rows, run state, restarts and replays."""

import json
from datetime import UTC, datetime
from pathlib import Path

import pytest

from weftline.streaming import lineage, sinks, sources

EVENTS = "event_id long, run_id string, state string, hours long"
SHAPE = "event_id BIGINT, run_id STRING, state STRING, ts TIMESTAMP, value DOUBLE"


def at(hours):
    return datetime.fromtimestamp(1_700_000_000 + 3600 * hours, UTC).replace(tzinfo=None)


def arrive(spark, path, *batches):
    """A file for each batch of (event_id, run_id, state, hours)."""
    rows = [(*r, i) for i, batch in enumerate(batches) for r in batch]
    frame = spark.createDataFrame(rows, EVENTS + ", part int").selectExpr(
        "event_id", "run_id", "state", "timestamp_seconds(1700000000 + 3600 * hours) AS ts", "CAST(hours AS DOUBLE) AS value", "part")
    sources.write_arrivals(frame, "part", len(batches), 1, path)


def stream(spark, path):
    return sources.file_stream(spark, path, SHAPE, files_per_batch=1)


def read(spark, path):
    return spark.read.option("basePath", path).parquet(f"{path}/batch_id=*")


ARRIVED = [
    [(1, "a", "START", 0), (2, "b", "START", 1), (3, "c", "START", 2)],
    [(4, "a", "RUNNING", 5), (5, "b", "COMPLETE", 6), (6, "d", "START", 6)],
    [(7, "a", "FAIL", 20), (8, "e", "START", 40)],
    [(9, "f", "COMPLETE", 60), (10, "d", "ABORT", 61)],
]


def lifecycle(spark, folder, checkpoint, out):
    found = lineage.run_lifecycle(stream(spark, folder), late_by="1 hour", settle_hours=12, timeout_hours=24)
    sinks.finish(sinks.start(found, out, checkpoint, "update", settings=sinks.ROCKSDB))
    return sorted((r.run_id, r.state, r.started_at, r.ended_at, r.n_events, r.closed) for r in sinks.latest_rows(read(spark, out), ["run_id"]).collect())


def test_runs_leave_the_state_and_a_restart_goes_on(spark, tmp_path):
    folder = str(tmp_path / "in")
    arrive(spark, folder, *ARRIVED)
    got = lifecycle(spark, folder, str(tmp_path / "check"), str(tmp_path / "out"))
    want = [
        ("a", "FAIL", at(0), at(20), 3, "ended"), ("b", "COMPLETE", at(1), at(6), 2, "ended"), ("c", "START", at(2), None, 1, "timed out"),
        # Its end comes in the batch that would have closed it, which keeps it open.
        ("d", "ABORT", at(6), at(61), 2, None), ("e", "START", at(40), None, 1, None), ("f", "COMPLETE", None, at(60), 1, None)]
    assert got == want
    closed = {(r.run_id, r.closed, r.n_events) for r in read(spark, str(tmp_path / "out")).filter("closed IS NOT NULL").collect()}
    assert closed == {("a", "ended", 3), ("b", "ended", 2), ("c", "timed out", 1)}
    # The same files in two runs with one checkpoint.
    folder = str(tmp_path / "in2")
    arrive(spark, folder, *ARRIVED[:2])
    lifecycle(spark, folder, str(tmp_path / "check2"), str(tmp_path / "out2"))
    arrive(spark, folder, *ARRIVED[2:])
    assert lifecycle(spark, folder, str(tmp_path / "check2"), str(tmp_path / "out2")) == want
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_repeats_of_other_batches_are_dropped_and_a_replay_changes_nothing(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    arrive(spark, folder, [(1, "a", "START", 0), (2, "a", "START", 1), (3, "b", "START", 1)], [(4, "a", "START", 0), (5, "a", "COMPLETE", 3)], [(6, "b", "START", 2), (7, "a", "COMPLETE", 3)])

    def edges():
        once = lineage.drop_repeats(stream(spark, folder), ["run_id", "state"], "2 days")
        shaped = once.selectExpr("ts", "run_id AS in_a", "'x' AS in_b", "'job' AS job_name", "'y' AS out_a")
        sinks.finish(sinks.start(shaped, out, checkpoint, transform=lineage.batch_edges))
        return sorted((r.src, r.dst, r.n_events) for r in lineage.merged_edges(read(spark, out)).collect())

    want = [("a", "job", 2), ("b", "job", 1), ("job", "y", 3), ("x", "job", 3)]
    assert edges() == want
    # Without its commit the last batch with rows comes again after a restart.
    commits = sorted((Path(checkpoint) / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    assert len(commits) >= 3
    last = commits[-1]
    said = last.read_text()
    last.rename(tmp_path / "commit-set-aside")
    (last.parent / f".{last.name}.crc").rename(tmp_path / "crc-set-aside")
    assert edges() == want and json.loads(last.read_text().split("\n")[1]).keys() == json.loads(said.split("\n")[1]).keys()


def test_late_rows_are_kept_apart(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, folder, [(1, "a", "START", 0), (2, "a", "START", 10)], [(3, "a", "START", 8), (4, "a", "START", 9), (5, "a", "START", 30)], [(6, "a", "START", 10), (7, "a", "START", 29)])
    write = sinks.split_late("1 hour")
    sinks.finish(sinks.start(stream(spark, folder), out, str(tmp_path / "check"), write=write))
    rows = read(spark, out)
    got = sorted((r.event_id, r.batch_id, r.late, r.watermark) for r in rows.collect())
    assert got == [(1, 0, "false", None), (2, 0, "false", None), (3, 1, "true", at(9)), (4, 1, "false", at(9)), (5, 1, "false", at(9)), (6, 2, "true", at(29)), (7, 2, "false", at(29))]
    # The second batch once more: same clock, same rows.
    write(spark.createDataFrame(
        [(3, "a", "START", at(8), 8.0), (4, "a", "START", at(9), 9.0), (5, "a", "START", at(30), 30.0)], SHAPE), 1, out)
    assert sorted((r.event_id, r.batch_id, r.late, r.watermark) for r in read(spark, out).collect()) == got


def test_bad_setting_is_taken_back(spark, tmp_path):
    folder = str(tmp_path / "in")
    arrive(spark, folder, ARRIVED[0])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(Exception):  # noqa: B017
        sinks.start(stream(spark, folder).groupBy("run_id").count(), str(tmp_path / "o"), str(tmp_path / "c"), "append", settings={"spark.sql.shuffle.partitions": "2"})
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_slot_of_runs_is_one_access_to_the_state():
    import pandas as pd

    calls, held, timers = [], {}, set()

    class Value:
        def exists(self):
            calls.append("exists")
            return "v" in held

        def get(self):
            calls.append("get")
            return held["v"]

        def update(self, value):
            calls.append("update")
            held["v"] = value

        def clear(self):
            held.clear()

    class Handle:
        def getValueState(self, name, shape):
            return Value()

        def registerTimer(self, due):
            calls.append("timer")
            timers.add(due)

        def deleteTimer(self, due):
            timers.remove(due)

        def listTimers(self):
            return list(timers)

    class Clock:
        def __init__(self, now):
            self.now = now

        def getCurrentWatermarkInMs(self):
            return self.now

    def said(frames):
        return sorted((r.run_id, r.state, r.n_events, r.closed) for f in frames for r in f.itertuples())

    processor = lineage.RunLifecycle(settle_ms=10, timeout_ms=100)
    processor.init(Handle())
    rows = [(f"r{i}", state, 2 * i + j, 1000 * (i + j)) for i in range(500) for j, state in enumerate(("START", "COMPLETE" if i % 2 else "RUNNING"))]
    parts = [pd.DataFrame(rows[a:a + 300], columns=["run_id", "state", "event_id", "at"]) for a in range(0, 1000, 300)]
    got = said(processor.handleInputRows((7,), iter(parts), Clock(0)))
    assert got == sorted((f"r{i}", "COMPLETE" if i % 2 else "RUNNING", 2, None) for i in range(500))
    assert len(calls) <= 4 and timers == {1 + 1 + 10}
    # Runs with an end are due 10 ms after their last row, the others 100 ms after.
    timers.clear()
    assert said(processor.handleExpiredTimer((7,), Clock(200), None)) == sorted(
        [(f"r{i}", "COMPLETE", 2, "ended") for i in range(1, 190, 2)] + [(f"r{i}", "RUNNING", 2, "timed out") for i in range(0, 100, 2)])
    assert timers == {100 + 1 + 100}
    # A later row of an open run moves it; the timer that is left comes too early and finds nothing.
    assert said(processor.handleInputRows((7,), iter([pd.DataFrame([("r100", "RUNNING", 5000, 900_000)], columns=["run_id", "state", "event_id", "at"])]), Clock(200))) == [("r100", "RUNNING", 3, None)]
    timers.clear()
    assert not said(processor.handleExpiredTimer((7,), Clock(201), None)) and timers == {191 + 1 + 10}
    left = said(processor.handleExpiredTimer((7,), Clock(10_000), None))
    assert len(left) == 500 - 95 - 50 and ("r100", "RUNNING", 3, "timed out") in left and not held
