"""Streams with rows out of order, restarts, last frames and bounded state."""
import datetime
import random

import pytest

from cadenza.streaming import ordered as O

T0 = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
SCHEMA = "clip_id string, ts timestamp, event_id long, v double"


def row(c, sec, i, v):
    return c, T0 + datetime.timedelta(seconds=sec), i, v


def drain(spark, made, batches, path, schema=SCHEMA):
    """Writes each batch as a file, runs the stream until it is read, and stops it; every run starts from the checkpoint."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        with O.state_store(spark):
            q = made(spark.readStream.schema(schema).parquet(f"{path}/in")).writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/ck").trigger(availableNow=True).start()
            q.awaitTermination(120)
        assert q.exception() is None
        yield k, q, spark.read.parquet(f"{path}/out")


def test_shuffled_rows_give_the_batch_result_over_restarts(spark, tmp_path):
    rng = random.Random(2)
    rows = [row(c, 10 * i + rng.randint(0, 3), i, float(i)) for c in ("a", None) for i in range(40)]
    rows = sorted(rows, key=lambda r: r[1].timestamp() + rng.uniform(0, 90))  # up to 90 s late
    batches = [rows[:25], rows[25:50], rows[50:], [row(None, 9000, 0, None)]]
    for _, q, out in drain(spark, lambda s: O.ordered_triplets(s, "100 seconds", 3_000_000), batches, tmp_path):
        pass
    got = sorted((str(r.clip_id), r.event_id, r.x, r.x1, r.x2) for r in out.collect())
    n = lambda v: float(v) if v >= 0 else None
    assert got == sorted((c, i, float(i), n(i - 1), n(i - 2)) for c in ("a", "None") for i in range(40))
    # the clips have been silent for longer than they may: timers and rows are gone
    state = lambda op: spark.read.format("state-metadata").load(str(tmp_path / "ck")).filter(f"operatorName LIKE '%{op}%'").count()
    assert state("transformWithState") > 0
    left = spark.read.format("statestore").option("stateVarName", "waiting").load(str(tmp_path / "ck")).count()
    held = spark.read.format("statestore").option("stateVarName", "memory").load(str(tmp_path / "ck")).count()
    assert (left, held) == (0, 0)


@pytest.mark.parametrize("n", [1, 2, 5, 6])
def test_streamed_deflicker_equals_batch(spark, tmp_path, n):
    from cadenza.operators.vision import deflicker

    kind = "clip_id string, ts timestamp, frame_idx long, px array<double>"
    rows = [(*row("c", i, i, None)[:3], [float((i * 37) % 90), 250.0 if i == 1 else 10.0 + i]) for i in range(n)]
    late = rows[::-1]
    for _, _, out in drain(spark, lambda s: O.stream_deflicker(s, "10 seconds", 20_000), [late[: n // 2] + late[n // 2 + 1 :], [late[n // 2], ("x", row("x", 500, 0, None)[1], 0, None)]], tmp_path, kind):
        pass
    want = deflicker(spark.createDataFrame([(c, i, p) for c, _, i, p in rows], "clip_id string, frame_idx long, px array<double>"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.select("clip_id", "frame_idx", "px").collect()))


def test_a_silence_starts_a_clip_anew_however_the_rows_arrive(spark, tmp_path):
    rows = [row("a", t, i, float(i)) for i, t in enumerate((0, 1, 2, 500, 501))]
    for name, batches in (("one", [rows]), ("two", [rows[:4], rows[4:]])):
        for _, _, out in drain(spark, lambda s: O.ordered_triplets(s, "5 seconds", 60_000), [*batches, [row(None, 9000, 0, None)]], tmp_path / name):
            pass
        assert sorted((r.event_id, r.x1, r.x2) for r in out.collect()) == [(0, None, None), (1, 0.0, None), (2, 1.0, 0.0), (3, None, None), (4, 3.0, None)]


class Held:
    """A state variable of one clip, in memory."""

    def __init__(self):
        self.kept = {}

    def getValue(self, k):
        return self.kept.get(k)

    def updateValue(self, k, v):
        self.kept[k] = v

    def removeKey(self, k):
        self.kept.pop(k, None)

    def exists(self):
        return bool(self.kept)

    def get(self):
        return self.kept.get(())

    def update(self, v):
        self.kept[()] = v

    def clear(self):
        self.kept.clear()


class Handle:
    def __init__(self):
        self.timers = set()

    def getMapState(self, *_):
        return Held()

    getValueState = getMapState

    def registerTimer(self, ms):
        self.timers.add(ms)


@pytest.mark.parametrize("hours", [1, 40])
def test_a_timer_takes_the_rows_of_one_hour(hours):
    """However many rows a batch brings, a task has those of an hour at once; what comes out is in order all the same."""
    from types import SimpleNamespace

    import pandas as pd

    rng, handle, p = random.Random(hours), Handle(), O.Triplets(O.MONTH)
    p.init(handle)
    rows = [(h * O.HOUR + rng.randrange(O.HOUR), i % 7, float(i), False) for h in range(-hours // 2, hours // 2 + 1) for i in range(500)]
    rows += rows[::50]  # repeated rows all come out
    came = rng.sample(rows, len(rows))
    list(p.handleInputRows(("a",), iter([pd.DataFrame(came[k : k + 1000], columns=["us", "event_id", "v", "beat"]) for k in range(0, len(came), 1000)]), None))
    mark = SimpleNamespace(getCurrentWatermarkInMs=lambda: 10**12)
    fired = [list(p.handleExpiredTimer(("a",), mark, SimpleNamespace(getExpiryTimeInMs=lambda t=t: t))) for t in sorted(handle.timers)]
    assert max(sum(map(len, f)) for f in fired) <= 600
    got = [r for f in fired for x in f for r in x.itertuples(index=False)]
    want = sorted(rows)
    assert [(r.event_id, r.x) for r in got] == [r[1:3] for r in want]
    assert [r.x1 for r in got[1:]] == [r[2] for r in want[:-1]] and [r.x2 for r in got[2:]] == [r[2] for r in want[:-2]]
    assert not p.waiting.exists() and not p.parts.exists()


def test_a_clip_of_many_hours_over_batches(spark, tmp_path):
    rng = random.Random(4)
    rows = [row(c, 3000 * i - 100_000 + rng.randint(0, 3), i, float(i)) for c in ("a", None) for i in range(60)]
    rows = sorted(rows, key=lambda r: r[1].timestamp() + rng.uniform(0, 7000))  # hours late
    for _, _, out in drain(spark, lambda s: O.ordered_triplets(s, "3 hours", O.MONTH), [rows[:50], rows[50:], [row(None, 40 * 86400, 0, None)]], tmp_path):
        pass
    n = lambda v: float(v) if v >= 0 else None
    assert sorted((str(r.clip_id), r.event_id, r.x, r.x1, r.x2) for r in out.collect()) == sorted((c, i, float(i), n(i - 1), n(i - 2)) for c in ("a", "None") for i in range(60))


def test_deflicker_takes_the_frames_of_one_hour():
    """As above with frames, which Arrow cannot sort: of equal time and number the smaller pixels go first."""
    from types import SimpleNamespace

    import pandas as pd

    handle, p = Handle(), O.Deflicker(O.MONTH, 10.0)
    p.init(handle)
    rows = [(i * O.HOUR // 20, i, [float(i % 50), 5.0], False) for i in range(200)] + [(0, 0, [-1.0, 9.0], False)]
    came = random.Random(1).sample(rows, len(rows))
    list(p.handleInputRows(("a",), iter([pd.DataFrame(came, columns=["us", "event_id", "v", "beat"])]), None))
    mark = SimpleNamespace(getCurrentWatermarkInMs=lambda: 10**12)
    fired = [list(p.handleExpiredTimer(("a",), mark, SimpleNamespace(getExpiryTimeInMs=lambda t=t: t))) for t in sorted(handle.timers)]
    assert len(fired) == 10 and max(sum(map(len, f)) for f in fired) <= 22
    px = [r[2] for r in sorted(rows, key=lambda r: r[:3])]
    want = [px[0]] + [[max(min(a, b) - 10, min(max(a, b) + 10, v)) for a, v, b in zip(*px[k - 1 : k + 2])] for k in range(1, 200)] + [px[200]]
    assert [r.px for f in fired for x in f for r in x.itertuples(index=False)] == want


def fire(p, handle, ms=10**13):
    """What each timer gives, in their order, once the watermark is there."""
    from types import SimpleNamespace

    mark = SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    return [list(p.handleExpiredTimer(("a",), mark, SimpleNamespace(getExpiryTimeInMs=lambda t=t: t))) for t in sorted(handle.timers)]


def given(p, rows, n=10_000):
    import pandas as pd

    list(p.handleInputRows(("a",), iter([pd.DataFrame(rows[k : k + n], columns=["us", "event_id", "v", "beat"]) for k in range(0, len(rows), n)]), None))


@pytest.mark.parametrize("kind", ["sparse", "dense"])
def test_packets_and_timers_follow_the_rows(kind):
    """An hour each would be 5,000 timers for as many rows, or all rows at once."""
    rng, handle, p = random.Random(3), Handle(), O.Deflicker(O.MONTH, 10.0)
    p.init(handle)
    step = O.HOUR if kind == "sparse" else O.HOUR // 100_000
    rows = [((i - 2000) * step, i, [float(i % 50)], False) for i in range(5_000 if kind == "sparse" else 100_000)]
    given(p, rng.sample(rows, len(rows)))
    fired = fire(p, handle)
    assert len(fired) <= 130 and max(sum(map(len, f)) for f in fired) < 30_000
    assert [r.frame_idx for f in fired for x in f for r in x.itertuples(index=False)] == list(range(len(rows) - (p.memory.get() is not None)))
    assert not p.waiting.exists() and not p.parts.exists() and not p.kept.exists()


def test_large_frames_go_on_by_bytes():
    handle, p = Handle(), O.Deflicker(O.MONTH, 10.0)
    p.init(handle)
    given(p, [(i, i, [float(i)] * 30_000, False) for i in range(40)])  # 9.6 MB within a millisecond
    fired = fire(p, handle)
    assert max(len(x) for f in fired for x in f) <= 10 and [i for f in fired for x in f for i in x["frame_idx"]] == list(range(40))


def test_waiting_packets_are_widened(spark, tmp_path):
    """Rows of a few hours wait when a batch of many hours comes: all leave in order, and nothing stays."""
    day = 86_400
    few = [row("a", 600 * i, i, float(i)) for i in range(60)]
    many = [row("a", 36_000 + 7_200 * i, 60 + i, float(60 + i)) for i in range(400)]
    batches = [few[30:], few[:30] + random.Random(5).sample(many, 400), [row("a", 120 * day, 0, None)], [row("a", 300 * day, 0, None)]]
    for _, _, out in drain(spark, lambda s: O.ordered_triplets(s, "60 days", O.MONTH), batches, tmp_path):
        pass
    n = lambda v: float(v) if v >= 0 else None
    assert sorted((r.event_id, r.x, r.x1, r.x2) for r in out.collect()) == [(i, float(i), n(i - 1), n(i - 2)) for i in range(460)]
    for name in ("waiting", "parts", "kept", "memory"):
        assert spark.read.format("statestore").option("stateVarName", name).load(str(tmp_path / "ck")).count() == 0
