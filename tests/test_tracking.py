"""Tracks against a plain loop over all frames."""
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from cadenza.operators import tracking as T

SCHEMA = "clip_id string, frame_idx long, candidates array<struct<x:double,y:double,r:double,circ:double>>"


def plain(frames, limit):
    """The rule told once more, frame by frame."""
    pos = old = None
    lost, out = 0, []
    for cands in frames:
        best, state = None, "missing" if not cands else "none"
        if pos is None and cands:
            top = max(cands, key=lambda c: c[3])
            if top[3] >= 0.55:
                best, state, old, pos, lost = top, "start", None, top[:2], 0
        elif pos is not None:
            near = min(cands, key=lambda c: math.dist(c[:2], pos), default=None)
            if near and math.dist(near[:2], pos) <= limit * (lost + 1):
                best, state, old, pos, lost = near, "ok", pos, near[:2], 0
            else:
                state = "missing" if not near else "far" if lost else "teleport"
                lost += 1
                if lost > 3:
                    pos = old = None
        far = max(60, min(150, 1.5 * math.dist(pos, old))) if pos and old else 60
        two = best is not None and any(8 <= math.dist(best[:2], c[:2]) <= far for c in cands if c is not best)
        out.append((state, best and best[0], best is not None and best[3] < 0.65, two))
    return out


def states(spark, xs, **more):
    rows = [("c", i, [] if x is None else [(float(x), 0.0, 4.0, 0.9)]) for i, x in enumerate(xs)]
    return [r.state for r in sorted(T.track(spark.createDataFrame(rows, SCHEMA), **more).collect(), key=lambda r: r.frame_idx)]


def test_a_jump_leaves_the_track_where_it_was(spark):
    assert states(spark, [0, 30, 300, 40]) == ["start", "ok", "teleport", "ok"]
    assert states(spark, [0, 30, 900, 900, 900, 900, 900]) == ["start", "ok", "teleport", "far", "far", "far", "start"]
    assert states(spark, [0, None, None, 380, None, None, None, None, 900]) == ["start", "missing", "missing", "ok", "missing", "missing", "missing", "missing", "start"]
    assert states(spark, [0, 200], fps=25) == ["start", "ok"]


@pytest.mark.parametrize("stretch", [1, 7, 4096])
def test_a_long_clip_equals_a_plain_loop(spark, stretch):
    rng = random.Random(stretch)
    n, rows = {1: 300, 7: 3000, 4096: 100_000}[stretch], []
    x, y = 0.0, 0.0
    for _ in range(n):
        x, y = x + rng.uniform(-60, 60), y + rng.uniform(-60, 60)
        if rng.random() < 0.02:
            x += rng.choice([-1, 1]) * 900
        near = [(x, y, 4.0, rng.uniform(0.4, 1))] if rng.random() < 0.85 else []
        rows.append(near + [(x + rng.uniform(-200, 200), y + rng.uniform(-200, 200), 4.0, rng.uniform(0.4, 1)) for _ in range(rng.choice([0, 0, 1, 2]))])
    held = pa.table({"clip_id": pa.array(["a"] * n), "frame_idx": pa.array(range(n), pa.int64()), "candidates": pa.array([[dict(zip(("x", "y", "r", "circ"), c)) for c in r] for r in rows])})
    d = spark.createDataFrame(held).repartition(6)
    got = sorted(T.track(d, stretch=stretch).collect(), key=lambda r: r.frame_idx)
    assert [(r.state, r.x, r.deformed, r.duplicate) for r in got] == plain(rows, 130.0)


def test_null_clips_missing_frames_and_nothing(spark):
    rows = [(None, i, [(float(i), 0.0, 4.0, 0.9)]) for i in range(6)] + [("b", 9000, None), ("b", 9001, [(1.0, 1.0, 4.0, 0.5)])]
    got = {(r.clip_id, r.frame_idx): r.state for r in T.track(spark.createDataFrame(rows, SCHEMA), stretch=2).collect()}
    assert [got[None, i] for i in range(6)] == ["start"] + ["ok"] * 5 and got["b", 9000] == "missing" and got["b", 9001] == "none"
    assert T.track(spark.createDataFrame([], SCHEMA)).count() == 0


def test_scores(spark):
    frames = [("a", i, "ok", 1.0, 1.0, False, i < 15) for i in range(100)] + [("b", i, "missing", None, None, False, False) for i in range(100)] + [("c", i, "ok" if i < 4 else "missing", 1.0 if i < 4 else None, 1.0, False, False) for i in range(100)]
    t = spark.createDataFrame(frames, T.WALKED)
    score = lambda c=None: {r.clip_id: r.score for r in T.track_scores(t, c).collect()}
    assert np.allclose([score()[k] for k in "abc"], [3.0, 1.0, 5 - 0.04 / 0.08 * 1.5])
    context = spark.createDataFrame([("a", 0.1, None, None), ("b", 0.5, False, None), ("c", 0.5, True, 50)], "clip_id string, pitch_share double, has_ball boolean, source_tracked long")
    assert np.allclose([score(context)[k] for k in "abc"], [5.0, 5.0, 5 - (0.70 - 0.04) / 0.70 * 2])


def test_frames_are_made_once(spark):
    """However many rounds the stretches need, what makes the frames runs once."""
    from pyspark.sql import functions as F

    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(k):
        made.add(1)
        return k

    rows = [("c", i, [(float(i), 0.0, 4.0, 0.9)]) for i in range(60)]
    got = T.track(spark.createDataFrame(rows, SCHEMA).withColumn("frame_idx", seen("frame_idx")), stretch=8).collect()
    assert sorted(r.frame_idx for r in got) == list(range(60)) and made.value == 60
