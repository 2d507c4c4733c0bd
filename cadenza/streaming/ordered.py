"""Streams whose rows arrive out of order: keyed state with timers, by transformWithState.

Rows of a clip wait in map state, packed by stretches of time, until the watermark has passed their time, then leave in
order of time and id; what an operator remembers of the rows before is a value state. Timers fire in order of
time, each for one stretch of one clip, so a task holds no more rows than those at once, however many a batch brings. A stretch
is an hour; it is halved for dense clips and doubled for clips of few rows over many hours, so that the work of packets and
timers follows the rows, not the hours. A clip that has been silent for
`idle` is finished by a timer and its state deleted (a row after such a silence starts anew), so state holds the rows of the watermark's delay and
one value a clip that still runs. These operators need the RocksDB state store (`state_store`).

A row without a value is a heartbeat: it moves the watermark and is not emitted. Rows later than the
watermark are dropped, as are rows without time; null clips are a clip; repeated rows are all emitted.
"""
import contextlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from cadenza.session import scratch_path

MONTH = 30 * 86_400_000  # the table has no silence as long as that, so its clips are whole
HOUR = 3_600_000_000  # microseconds of a packet of waiting rows, to begin with
#: Rows that a task packs at once as they come, and those it hands on at once; the bytes of either, which large frames reach first.
PACK, HAND = 100_000, 10_000
PACK_BYTES, HAND_BYTES = 16 << 20, 2 << 20
#: Bytes of a packet: stretches are doubled below the first if there are more than FEW, and halved above the second.
LEAST, MOST, FEW = 32 << 10, 512 << 10, 64
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def state_store(spark: SparkSession):
    """Sets the state store these operators need while queries start; the session's own setting comes back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STORE)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def _bytes(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as w:
        w.write_table(rows)
    return sink.getvalue().to_pybytes()


def _sorted(rows: pa.Table) -> pa.Table:
    """By time and id, then value."""
    us, ids = rows["us"].to_numpy(), rows["id"].to_numpy()
    if pa.types.is_floating(rows.schema.field("v").type):
        return rows.take(np.lexsort((rows["v"].to_numpy(), ids, us)))
    order = np.lexsort((ids, us))
    us, ids = us[order], ids[order]
    starts = np.flatnonzero(np.r_[True, (us[1:] != us[:-1]) | (ids[1:] != ids[:-1])])
    ends = np.r_[starts[1:], len(order)]
    for k in np.flatnonzero(ends - starts > 1):
        s, e = starts[k], ends[k]
        order[s:e] = sorted(order[s:e], key=lambda k: rows["v"][k].as_py())
    return rows.take(order)


def _fitting(us, size: int, width: int, fresh: bool) -> int:
    """The stretch for packets of rows at these ascending times, of so many bytes; fresh: none waits that would be too wide."""
    count = lambda w: np.count_nonzero(np.diff(us // w)) + 1
    while fresh and width % 2000 == 0 and size > MOST * count(width):  # whole milliseconds, as timers have
        width //= 2
    while (n := count(width)) > FEW and size < LEAST * n:
        width *= 2
    return width


class Ordered(StatefulProcessor):
    """Hands rows (ts in microseconds, id, v) to `advance` in order; subclasses say what they remember and emit."""

    kind, past, out = pa.float64(), "", []

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle):
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "start long, part int", "rows binary")
        self.parts = handle.getMapState("parts", "start long", "n int")
        self.kept = handle.getValueState("kept", "width long, n long")  # the stretch of all packets, and how many stretches wait
        self.memory = handle.getValueState("memory", f"last long, {self.past}")

    def handleInputRows(self, key, rows, timerValues):
        held, size, n_bytes, ends = [], 0, 0, {}
        for pdf in rows:
            pdf = pdf[~pdf["beat"].to_numpy(bool)]
            if len(pdf):
                held.append(pa.table({"us": pa.array(pdf["us"].to_numpy(np.int64)), "id": pa.array(pdf["event_id"].to_numpy(np.int64)), "v": self.values(pdf["v"])}))
                size, n_bytes = size + len(pdf), n_bytes + held[-1].nbytes
            if size >= PACK or n_bytes >= PACK_BYTES:
                self._pack(pa.concat_tables(held), ends)
                held, size, n_bytes = [], 0, 0
        if size:
            self._pack(pa.concat_tables(held), ends)
        for end in ends.values():
            # one timer a batch and stretch: it fires when the watermark has passed the last row of them, and frees all rows before
            self.handle.registerTimer(end // 1000 + 1)
        return iter([])

    def _pack(self, x, ends):
        """Adds rows to the packets of their stretches; ends gets the last time of each."""
        x = x.take(np.argsort(x["us"].to_numpy(), kind="stable"))
        us, kept = x["us"].to_numpy(), self.kept.get()
        old, n = kept or (HOUR, 0)
        width = _fitting(us, x.nbytes, old, not n)
        if n and width > old:
            n = self._widen(width)
        at = us // width * width
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        for s, e in zip(starts, np.r_[starts[1:], len(at)]):
            start, end = int(at[s]), int(us[e - 1])
            parts = (self.parts.getValue((start,)) or (0,))[0]
            n += not parts
            self.waiting.updateValue((start, parts), (_bytes(x.slice(s, e - s)),))
            self.parts.updateValue((start,), (parts + 1,))
            ends[start] = max(end, ends.get(start, end))
        self.kept.update((width, n))

    def _widen(self, width):
        """Moves the waiting packets to wider stretches, each of which holds whole ones of before; returns how many there are now."""
        now = {}
        for start, parts in sorted((k[0], v[0]) for k, v in self.parts.iterator()):
            to = start // width * width
            if to != start:
                for k in range(parts):
                    self.waiting.updateValue((to, now.get(to, 0) + k), tuple(self.waiting.getValue((start, k))))
                    self.waiting.removeKey((start, k))
                self.parts.removeKey((start,))
            now[to] = now.get(to, 0) + parts
        for to, parts in now.items():
            self.parts.updateValue((to,), (parts,))
        return len(now)

    def _ready(self, us, mark):
        """The rows of the stretch of this time that the watermark has passed, sorted, which leave the state; whether others wait."""
        kept = self.kept.get()
        if kept is None:
            return None, False
        width, stretches = kept
        start = us // width * width
        n = self.parts.getValue((start,))
        if n is None:
            return None, True
        rows = _sorted(pa.concat_tables([pa.ipc.open_stream(self.waiting.getValue((start, k))[0]).read_all() for k in range(n[0])]))
        free = int(np.searchsorted(rows["us"].to_numpy(), mark))
        if not free:
            return None, True
        for k in range(n[0]):
            self.waiting.removeKey((start, k))
        if free < len(rows):
            self.waiting.updateValue((start, 0), (_bytes(rows.slice(free)),))
            self.parts.updateValue((start,), (1,))
            return rows.slice(0, free), True
        self.parts.removeKey((start,))
        if stretches > 1:
            self.kept.update((width, stretches - 1))
        else:
            self.kept.clear()
        return rows, stretches > 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark, idle = timerValues.getCurrentWatermarkInMs() * 1000, self.idle_ms * 1000
        rows, wait = self._ready((expiredTimerInfo.getExpiryTimeInMs() - 1) * 1000, mark)  # the others' timers follow
        memory = self.memory.get()
        last, past = (memory[0], tuple(memory[1:])) if memory is not None else (None, None)
        emit = lambda out: pd.DataFrame([(key[0], *r) for r in out], columns=["clip_id", *self.out])
        hand = min(HAND, 1 + HAND_BYTES * len(rows) // rows.nbytes) if rows is not None else HAND
        for k in range(0, len(rows) if rows is not None else 0, hand):
            some, out, at = rows.slice(k, hand), [], 0
            ready = list(zip(*(some[c].to_pylist() for c in ("us", "id", "v"))))
            while at < len(ready):  # stretches without a silence of `idle`
                end = next((k for k in range(at + 1, len(ready)) if ready[k][0] - ready[k - 1][0] > idle), len(ready))
                if past is not None and ready[at][0] - last > idle:
                    out, past = out + self.finish(past), None
                past, more = self.advance(past, ready[at:end])
                out, last, at = out + more, ready[end - 1][0], end
            yield emit(out)
        if past is not None and not wait and last + idle < mark:  # nothing came for so long, and nothing that is not late can come
            yield emit(self.finish(past))
            past = None
        if past is None:
            self.memory.clear()
        elif rows is not None:
            self.memory.update((last, *past))
            if not wait:
                self.handle.registerTimer((last + idle) // 1000 + 2)

    def finish(self, past):
        return []

    def values(self, v):
        return pa.array(v.to_numpy(float), self.kind)


class Triplets(Ordered):
    past, out = "x1 double, x2 double", ["event_id", "x", "x1", "x2"]

    def advance(self, past, rows):
        x1, x2 = past or (None, None)
        out = []
        for _, i, x in rows:
            out.append((i, x, x1, x2))
            x1, x2 = x, x1
        return (x1, x2), out


class Deflicker(Ordered):
    """Holds a frame back until the next one is there: before array, held array and its number."""

    kind, past, out = pa.list_(pa.float64()), "id long, px array<double>, before array<double>", ["frame_idx", "px"]

    def __init__(self, idle_ms, margin):
        super().__init__(idle_ms)
        self.margin = margin

    def values(self, v):
        return pa.array([np.asarray(x, float) for x in v], self.kind)

    def advance(self, past, rows):
        i, px, before = past or (None, None, None)
        out = []
        for _, k, now in rows:
            now = list(now)
            if px is not None:
                out.append((i, list(px) if before is None else self.held(before, px, now)))
            i, before, px = k, px, now
        return (i, px, before), out

    def held(self, a, x, b):
        m = self.margin
        return [max(min(p, q) - m, min(max(p, q) + m, v)) for p, v, q in zip(a, x, b)]

    def finish(self, past):
        return [(past[0], list(past[1]))]  # a last frame has no neighbour and stays


def _run(stream: DataFrame, delay: str, processor, out: str) -> DataFrame:
    # heartbeats are told apart in the processor: a filter would be moved before the watermark, which would not see them
    x = stream.filter("ts is not null").withWatermark("ts", delay).select("clip_id", "ts", F.coalesce("event_id", F.lit(0)).cast("long").alias("event_id"), "v", F.unix_micros("ts").alias("us"), F.col("v").isNull().alias("beat"))
    return x.groupBy("clip_id").transformWithStateInPandas(processor, out, "append", "EventTime")


def ordered_triplets(stream: DataFrame, delay: str = "10 minutes", idle_ms: int = 3_600_000) -> DataFrame:
    """stream(clip_id, ts, event_id, v) in any order within `delay` -> (clip_id, event_id, x, x1, x2) with the two rows before."""
    return _run(stream, delay, Triplets(idle_ms), "clip_id string, event_id long, x double, x1 double, x2 double")


def stream_deflicker(stream: DataFrame, delay: str = "10 seconds", idle_ms: int = 60_000, margin: float = 10.0) -> DataFrame:
    """stream(clip_id, ts, frame_idx, px) -> (clip_id, frame_idx, px): inner frames held within their neighbours' envelope.

    Frames follow each other by ts and number; one leaves when the next has come, a clip's last after idle_ms.
    """
    x = stream.select("clip_id", "ts", F.col("frame_idx").alias("event_id"), F.col("px").alias("v"))
    return _run(x, delay, Deflicker(idle_ms, margin), "clip_id string, frame_idx long, px array<double>")


def _finished(stream: DataFrame, out: DataFrame, schema: str) -> DataFrame:
    """Runs a query over what is there and reads its rows."""
    spark = stream.sparkSession
    path = scratch_path(spark, "stream")
    with state_store(spark):
        q = out.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.schema(schema).parquet(path)


def _with_heartbeat(spark, sf_dir, ahead: str):
    """The events table as a stream, closed by a heartbeat `ahead` of its last row."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    beat = scratch_path(spark, "heartbeat")
    last = spark.read.parquet(path).agg(F.max("ts").cast("timestamp").alias("ts")).selectExpr("CAST(NULL AS STRING) AS clip_id", f"ts + interval {ahead} AS ts", "CAST(0 AS BIGINT) AS event_id", "CAST(NULL AS DOUBLE) AS v")
    last.write.parquet(beat)
    ev = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]").select(F.col("event_type").alias("clip_id"), F.col("ts").cast("timestamp").alias("ts"), "event_id", F.col("value").alias("v"))
    return ev.unionByName(spark.readStream.schema(last.schema).parquet(beat))


def stream_ordered(spark, sf_dir):
    """Second-order residuals of the events table as a stream, in order of time whatever the order of its rows."""
    x = _with_heartbeat(spark, sf_dir, "40 days")
    rows = _finished(x, ordered_triplets(x, idle_ms=MONTH), "clip_id string, event_id long, x double, x1 double, x2 double")
    return rows.filter("x2 is not null").select("clip_id", "event_id", F.round(F.abs(F.col("x1") - (F.col("x2") + F.col("x")) / 2), 6).alias("resid"))


def stream_envelope(spark, sf_dir):
    """The events table as a stream of one-pixel frames, held within their neighbours' envelope; every row comes out."""
    x = _with_heartbeat(spark, sf_dir, "40 days").select("clip_id", "ts", F.col("event_id").alias("frame_idx"), F.when(F.col("v").isNotNull(), F.array("v")).alias("px"))
    rows = _finished(x, stream_deflicker(x, idle_ms=MONTH), "clip_id string, frame_idx long, px array<double>")
    return rows.select("clip_id", "frame_idx", F.round(F.get("px", F.lit(0)), 6).alias("v"))


QUERIES = {f.__name__: f for f in (stream_ordered, stream_envelope)}
_L = "WITH l AS (SELECT event_type AS clip_id, event_id, value AS x, lag(value, 1) OVER w AS x1, lag(value, 2) OVER w AS x2, lead(value, 1) OVER w AS xn FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))"
ORACLES = {
    "stream_ordered": f"{_L} SELECT clip_id, event_id, round(abs(x1 - (x2 + x) / 2), 6) AS resid FROM l WHERE x2 IS NOT NULL",
    "stream_envelope": f"{_L} SELECT clip_id, event_id AS frame_idx, round(CASE WHEN x1 IS NULL OR xn IS NULL THEN x ELSE greatest(least(x1, xn) - 10, least(greatest(x1, xn) + 10, x)) END, 6) AS v FROM l",
}
