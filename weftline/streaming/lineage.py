"""Streaming transformations over run events and change streams."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftline.schemas import EVENT_TIME_FORMAT
from weftline.sources.emitters import dataset, job_type, run_event

TERMINAL = ["COMPLETE", "FAIL", "ABORT"]


def windowed_totals(stream: DataFrame, late_by: str = "10 minutes", width: str = "1 hour", keys: tuple[str, ...] = ()) -> DataFrame:
    """Count and sum per tumbling window; rows behind the watermark are dropped."""
    return stream.withWatermark("ts", late_by).groupBy(F.window("ts", width), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n", "total")


def window_events(windows: DataFrame, job: str, source: str, target: str) -> DataFrame:
    """One RUNNING run event per window with the rows it read and wrote."""
    at = F.date_format("window_start", EVENT_TIME_FORMAT)
    counts = F.struct(F.col("n").alias("rowsIn"), F.lit(1).alias("rowsOut"))
    return windows.select("window_start", run_event(
        "RUNNING", at, "stream", job, F.array(dataset("stream", source)), F.array(dataset("stream", target)),
        run_id=F.concat(F.lit(f"{job}-"), at), run_facets={"window": counts}).alias("event"))


def drop_repeats(stream: DataFrame, keys: list[str], late_by: str) -> DataFrame:
    """First event of each key, with the state of a key dropped once the watermark has passed it."""
    return stream.withWatermark("ts", late_by).dropDuplicatesWithinWatermark(keys)


#: Runs are dealt over so many slots, each with one state, by default.
SLOTS = 1024


class RunLifecycle(StatefulProcessor):
    """Keeps one row for each open run and gives it up by a timer on event time.

    A run that has ended waits ``settle_ms`` after its last event for stragglers, one without an end ``timeout_ms``; then it is
    closed as ``ended`` or ``timed out`` and leaves the state. Keys are slots of runs: every access to the state is a message
    to Spark, so the open runs of a slot are read and written as one value, with one timer for the first that is due.
    """

    STATE = "runs BINARY, due BIGINT"
    OPEN = pa.schema([("run_id", pa.string()), ("last_at", pa.int64()), ("last_id", pa.int64()), ("state", pa.string()), ("started_at", pa.int64()), ("ended_at", pa.int64()), ("n_events", pa.int64())])

    def __init__(self, settle_ms: int, timeout_ms: int):
        self.settle_ms, self.timeout_ms = settle_ms, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slot = handle.getValueState("slot", self.STATE)

    def _held(self) -> tuple[dict, int | None]:
        """Open runs of the slot by name, and when its timer is due."""
        if not self.slot.exists():
            return {}, None
        packed, due = self.slot.get()
        columns = [c.to_pylist() for c in pa.ipc.open_stream(packed).read_all().columns]
        return {run_id: tuple(rest) for run_id, *rest in zip(*columns, strict=True)}, due

    def _hold(self, runs: dict, due: int) -> None:
        columns = zip(*((k, *v) for k, v in runs.items()), strict=True)
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, self.OPEN) as stream:
            stream.write_batch(pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, self.OPEN, strict=True)], schema=self.OPEN))
        self.slot.update((out.getvalue().to_pybytes(), due))

    def _due(self, run: tuple) -> int:
        return run[0] // 1000 + (self.timeout_ms if run[4] is None else self.settle_ms)

    @staticmethod
    def _rows(runs: dict, closed: list) -> pd.DataFrame:
        _, _, state, started_at, ended_at, n_events = zip(*runs.values(), strict=True)
        whole = {"started_at": started_at, "ended_at": ended_at, "n_events": n_events}
        return pd.DataFrame({"run_id": list(runs), "state": state} | {k: pd.array(v, dtype="Int64") for k, v in whole.items()} | {"closed": closed})

    def handleInputRows(self, key, rows, timerValues):
        runs, due = self._held()
        touched = {}
        for run_id, now, event_id, said in (row for part in rows for row in zip(*(part[c].tolist() for c in ("run_id", "at", "event_id", "state")), strict=True)):
            last_at, last_id, state, started_at, ended_at, n_events = touched.get(run_id) or runs.get(run_id) or (None, None, None, None, None, 0)
            if last_at is None or (now, event_id) > (last_at, last_id):
                last_at, last_id, state = now, event_id, said
            if said == "START" and (started_at is None or now < started_at):
                started_at = now
            if said in TERMINAL and (ended_at is None or now > ended_at):
                ended_at = now
            touched[run_id] = (last_at, last_id, state, started_at, ended_at, n_events + 1)
        runs |= touched
        # A timer that comes too early finds nothing to close and is set anew; one that would come too late is replaced.
        first = min(map(self._due, touched.values()))
        if due is None or first < due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(first)
            due = first
        self._hold(runs, due)
        yield self._rows(touched, [None] * len(touched))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        runs, _ = self._held()
        now = timerValues.getCurrentWatermarkInMs()
        gone = {k: v for k, v in runs.items() if self._due(v) <= now}
        left = {k: v for k, v in runs.items() if k not in gone}
        if left:
            due = min(map(self._due, left.values()))
            self.handle.registerTimer(due)
            self._hold(left, due)
        elif runs:
            self.slot.clear()
        if gone:
            yield self._rows(gone, ["timed out" if v[4] is None else "ended" for v in gone.values()])

    def close(self) -> None:
        pass


def run_lifecycle(stream: DataFrame, late_by: str = "1 hour", settle_hours: int = 12, timeout_hours: int = 24, slots: int = SLOTS) -> DataFrame:
    """Latest state, start, end and event count of every run, once for each batch that has rows of it and once when it is closed.

    ``closed`` is null while a run is open, then ``ended`` or ``timed out``. Order is (ts, event_id), so the result does not
    depend on the order inside a batch. State holds open runs only, in ``slots`` values; it needs the RocksDB store (``sinks.start(..., settings=sinks.ROCKSDB)``).
    Rows behind the watermark are dropped. Rows that come in the batch that would close their run keep it open; rows of a closed run open it again.
    """
    # An event without an id is the first of its instant.
    least = F.coalesce("event_id", F.lit(-(2**63))).alias("event_id")
    rows = stream.withWatermark("ts", late_by).select("run_id", "state", least, "ts", F.unix_micros("ts").alias("at"), F.pmod(F.xxhash64("run_id"), F.lit(slots)).alias("slot"))
    shape = "run_id STRING, state STRING, started_at BIGINT, ended_at BIGINT, n_events BIGINT, closed STRING"
    found = rows.groupBy("slot").transformWithStateInPandas(RunLifecycle(settle_hours * 3_600_000, timeout_hours * 3_600_000), shape, "Update", "EventTime")
    return found.select("run_id", "state", F.timestamp_micros("started_at").alias("started_at"), F.timestamp_micros("ended_at").alias("ended_at"), "n_events", "closed")


def batch_edges(batch: DataFrame) -> DataFrame:
    """Edges of one micro-batch; repeated events are dropped ahead of it, over all batches (``drop_repeats``)."""
    return batch.selectExpr(
        "ts", "inline(array(named_struct('src', in_a, 'dst', job_name, 'type', 'CONSUMED_BY'), named_struct('src', in_b, 'dst', job_name, 'type', 'CONSUMED_BY'), "
        "named_struct('src', job_name, 'dst', out_a, 'type', 'PRODUCED_BY')))",
    ).groupBy("src", "dst", "type").agg(F.count("*").alias("n_events"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


def merged_edges(batches: DataFrame) -> DataFrame:
    """The edge table over all batches."""
    return batches.groupBy("src", "dst", "type").agg(
        F.sum("n_events").alias("n_events"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def change_events(changes: DataFrame, database: str, table: str, topic: str) -> DataFrame:
    """A RUNNING run event per captured change."""
    lifecycle = F.struct(F.col("operation").alias("lifecycleStateChange"))
    return changes.select("event_id", run_event(
        "RUNNING", F.date_format("ts", EVENT_TIME_FORMAT), f"cdc://{database}", f"debezium.{table}",
        F.array(dataset(f"postgres://{database}", table, lifecycleStateChange=lifecycle)), F.array(dataset("kafka://cluster", topic)),
        job_facets={"jobType": job_type("STREAMING", "DEBEZIUM", "CDC_CONNECTOR")}).alias("event"))


def latest_changes(batch: DataFrame) -> DataFrame:
    """Last change per key of a batch."""
    return batch.groupBy("key").agg(F.max(F.struct("ts", "event_id", "operation", "value")).alias("c")).select("key", "c.*")


def current_table(batches: DataFrame) -> DataFrame:
    """Merge-on-read view of a change log kept per batch: last change per key, deleted keys gone."""
    return latest_changes(batches).filter("operation <> 'DELETE'").select("key", "ts", "event_id", "value")


def compact(batches: DataFrame, path: str) -> None:
    """Rewrite the log as one row per key, deletions kept, so that later reads stay small."""
    latest_changes(batches).write.mode("overwrite").parquet(path)


def consumer_facet(offsets: DataFrame) -> DataFrame:
    """Per (consumer, topic): offsets of its partitions as JSON and their sum.

    ``total_lag`` is that sum too: the name the facet has carried although it is no lag.
    A topic's partitions are few, and each is reduced to its last offset first.
    """
    last = offsets.groupBy("consumer", "topic", "partition").agg(F.max("offset").alias("offset"))
    gathered = last.groupBy("consumer", "topic").agg(F.sort_array(F.collect_list(F.struct("partition", "offset"))).alias("parts"))
    as_map = F.map_from_entries(F.transform("parts", lambda p: F.struct(p["partition"].cast("string"), p["offset"])))
    total = F.aggregate(F.map_values(as_map), F.lit(0).cast("long"), lambda acc, x: acc + x)
    return gathered.select("consumer", "topic", F.to_json(as_map).alias("partition_offsets"), total.alias("total_lag"), total.alias("total_offset"))


def topic_topology(processors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed nodes and relations of processors (name, group_id, inputs[], outputs[], sinks[]).

    The consumer group is the processing node; topics and sinks are what it reads and writes.
    """
    edges = processors.selectExpr(
        "inline(concat(transform(inputs, i -> named_struct('src', i, 'dst', group_id, 'relation', 'consumed_by')), "
        "transform(outputs, o -> named_struct('src', group_id, 'dst', o, 'relation', 'produces')), "
        "transform(sinks, s -> named_struct('src', group_id, 'dst', s, 'relation', 'writes_to'))))").distinct()
    nodes = processors.selectExpr(
        "inline(concat(array(named_struct('id', group_id, 'type', 'processor')), transform(concat(inputs, outputs), i -> named_struct('id', i, 'type', 'topic')), "
        "transform(sinks, s -> named_struct('id', s, 'type', 'sink'))))").distinct()
    return nodes, edges
