"""Ball tracks over sequences of any length: stretches of frames in parallel, joined by the state they pass on.

A track follows the nearest candidate within its speed limit; a farther one leaves it where it was and
counts the frame as lost, as a frame without candidates does; after more than three lost frames it starts
anew with the roundest candidate. Every stretch is first walked from an empty track. Where the stretch
before it ends in another state than a stretch began with, it is walked again from that state, until
none differs: a track that is lost or meets the same candidate forgets how it began, so few are.
"""
import math
import operator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.plans import scoring
from cadenza.session import stored, table

#: Speed at 50 fps, frames lost before a new start, roundness to start and to count as whole, window of a second ball.
SPEED, LOST, ROUND, WHOLE, APART = 130.0, 3, 0.55, 0.65, (8.0, 60.0, 150.0)
STATE = "struct<x:double,y:double,x0:double,y0:double,lost:int>"
_STATE = pa.struct([(k, pa.float64()) for k in ("x", "y", "x0", "y0")] + [("lost", pa.int32())])
_ENDS = pa.schema([("clip_id", pa.string()), ("stretch", pa.int64()), ("entered", _STATE), ("left", _STATE)])
_WALKED = pa.schema([("clip_id", pa.string()), ("frame_idx", pa.int64()), ("state", pa.string()), ("x", pa.float64()), ("y", pa.float64()), ("deformed", pa.bool_()), ("duplicate", pa.bool_())])
WALKED = "clip_id string, frame_idx long, state string, x double, y double, deformed boolean, duplicate boolean"


def step(track, candidates, speed):
    """(track, state, candidate, duplicate) of one frame; candidates are (x, y, r, circ), a track is (x, y, x0, y0, lost), or None where nothing is followed."""
    best, state = None, "missing" if not candidates else "none"
    if track is None:
        top = max(candidates, key=_circ, default=None)
        if top and top[3] >= ROUND:
            best, track, state = top, (top[0], top[1], None, None, 0), "start"
    else:
        x, y, lost = track[0], track[1], track[4]
        near = min(candidates, key=lambda c: math.hypot(c[0] - x, c[1] - y), default=None)
        if near and math.hypot(near[0] - x, near[1] - y) <= speed * (lost + 1):
            best, track, state = near, (near[0], near[1], x, y, 0), "ok"
        else:
            state = state if not near else "far" if lost else "teleport"
            track = None if lost + 1 > LOST else (*track[:4], lost + 1)
    if best is None or len(candidates) < 2:
        return track, state, best, False
    moved = math.hypot(track[0] - track[2], track[1] - track[3]) if track[2] is not None else 0.0
    far = max(APART[1], min(APART[2], moved * 1.5))
    second = any(APART[0] <= math.hypot(best[0] - c[0], best[1] - c[1]) <= far for c in candidates if c is not best)
    return track, state, best, second


_circ = operator.itemgetter(3)
_FIELDS = ("x", "y", "x0", "y0", "lost")


def _frames(batches):
    """Rows of a sorted partition, one by one: clip, stretch, entered, frame, candidates; nothing is kept."""
    for t in batches:
        c = t.column("candidates")
        flat = list(zip(*(c.flatten().field(k).to_pylist() for k in ("x", "y", "r", "circ"))))
        ends = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(c), 0).to_numpy(False))].tolist()
        entered = t.column("entered")
        parts = [entered.field(k).to_pylist() for k in _FIELDS]
        states = [s if ok else None for s, ok in zip(zip(*parts), entered.is_valid().to_pylist())]
        for k, row in enumerate(zip(t.column("clip_id").to_pylist(), t.column("stretch").to_pylist(), states, t.column("frame_idx").to_pylist())):
            yield *row, flat[ends[k] : ends[k + 1]]


def _ends(speed):
    """Sorted frames -> the state each stretch is left in, with the one it began with."""
    row = lambda key, entered, left: {"clip_id": key[0], "stretch": key[1], "entered": entered and dict(zip(_FIELDS, entered)), "left": left and dict(zip(_FIELDS, left))}

    def run(batches):
        key, out, began, track = None, [], None, None
        for clip, stretch, entered, _, candidates in _frames(batches):
            if (clip, stretch) != key:
                if key:
                    out.append(row(key, began, track))
                key, began, track = (clip, stretch), entered, entered
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_pylist(out, schema=_ENDS)
                    out = []
            track = step(track, candidates, speed)[0]
        if key:
            yield pa.RecordBatch.from_pylist([*out, row(key, began, track)], schema=_ENDS)

    return run


def _walk(speed):
    """Sorted frames -> what became of each."""

    def run(batches):
        key, track = None, None
        for t in batches:
            states, xs, ys, bent, two = [], [], [], [], []
            for clip, stretch, entered, _, candidates in _frames([t]):
                if (clip, stretch) != key:
                    key, track = (clip, stretch), entered
                track, state, best, second = step(track, candidates, speed)
                states.append(state)
                xs.append(best and best[0])
                ys.append(best and best[1])
                bent.append(best is not None and best[3] < WHOLE)
                two.append(second)
            made = [pa.array(v, k) for v, k in zip((states, xs, ys, bent, two), _WALKED.types[2:])]
            yield pa.RecordBatch.from_arrays([t.column("clip_id"), t.column("frame_idx"), *made], schema=_WALKED)

    return run


def _in_order(frames: DataFrame) -> DataFrame:
    """Stretches whole in a partition and sorted there: Spark sorts, and a small stretch costs no group of its own."""
    return frames.select("clip_id", "stretch", "frame_idx", "candidates", "entered").repartition("clip_id", "stretch").sortWithinPartitions("clip_id", "stretch", "frame_idx")


def entering(frames: DataFrame, stretch: int, speed: float) -> DataFrame:
    """frames(clip_id, frame_idx, candidates, stretch) -> (clip_id, stretch, entered): the state every stretch begins with."""
    key, kind = ["clip_id", "stretch"], f"clip_id string, stretch long, entered {STATE}, left {STATE}"
    ends = lambda x: _in_order(x).mapInArrow(_ends(speed), kind)
    known = stored(ends(frames.withColumn("entered", F.lit(None).cast(STATE))))
    while True:
        before = F.lag("left").over(W.partitionBy("clip_id").orderBy("stretch"))  # one row a stretch
        seen = known.withColumn("should", before)
        wrong = stored(seen.filter(~F.col("should").eqNullSafe(F.col("entered"))).select(F.col("clip_id").alias("c"), F.col("stretch").alias("s"), "should"))
        if wrong.isEmpty():
            return known.select(*key, "entered")
        same = F.col("clip_id").eqNullSafe(F.col("c")) & (F.col("stretch") == F.col("s"))
        again = frames.join(wrong, same).withColumn("entered", F.col("should")).drop("c", "s", "should")
        known = stored(known.join(wrong, same, "left_anti").unionByName(ends(again)))


def track(frames: DataFrame, fps: float = 50.0, stretch: int = 4096, speed: float | None = None) -> DataFrame:
    """frames(clip_id, frame_idx, candidates array<struct<x, y, r, circ>>) -> (clip_id, frame_idx, state, x, y, deformed, duplicate).

    state: start, ok, teleport (the nearest candidate is too far from the last frame's), far (too far after
    lost frames; the step allowed grows with them), missing (no candidate) or none (no round one to start
    with). A null clip_id is a clip; null and empty candidates are none; of candidates equally near or round
    the first counts; rows of equal clip and frame follow each other in no stated order.
    """
    pick = F.transform("candidates", lambda c: F.struct(*[c[k].cast("double").alias(k) for k in ("x", "y", "r", "circ")]))
    # stored: each round would make the frames again
    x = stored(frames.select(F.col("clip_id").cast("string").alias("clip_id"), F.col("frame_idx").cast("long").alias("frame_idx"), pick.alias("candidates"), F.floor(F.col("frame_idx") / stretch).cast("long").alias("stretch")))
    limit = speed if speed is not None else SPEED * 50.0 / max(1.0, fps)
    begin = entering(x, stretch, limit).select(F.col("clip_id").alias("c"), F.col("stretch").alias("s"), "entered")
    x = x.join(begin, F.col("clip_id").eqNullSafe(F.col("c")) & (F.col("stretch") == F.col("s")))
    return _in_order(x).mapInArrow(_walk(limit), WALKED)


def track_scores(tracked: DataFrame, context: DataFrame | None = None) -> DataFrame:
    """tracked rows, context(clip_id, pitch_share, has_ball, source_tracked) -> one row a clip with counts, rates and score.

    has_ball null: a ball is expected where the pitch fills 15 % of the picture; source_tracked null: a wide
    pitch (40 %) with a tracked ball in under 8 % of 60 frames or more costs up to 1.5 instead.
    """
    n = tracked.groupBy("clip_id").agg(
        F.count("*").alias("frames"), F.count("x").alias("tracked"), F.count_if(F.col("state") == "teleport").alias("teleports"),
        F.count_if("duplicate").alias("duplicates"), F.count_if("deformed").alias("deformed"))
    if context is None:  # no join of the counts with themselves: the frames would be walked twice
        x = n.withColumns({"pitch_share": F.lit(1.0), "has_ball": F.lit(None).cast("boolean"), "source_tracked": F.lit(None).cast("long")})
    else:
        c = context.select(F.col("clip_id").alias("c"), "pitch_share", "has_ball", "source_tracked")
        x = n.join(c, F.col("clip_id").eqNullSafe(F.col("c")), "left").drop("c")
    return x.withColumn("score", scoring.ball_sequence(*[F.col(k) for k in ("frames", "tracked", "teleports", "duplicates", "deformed", "pitch_share", "has_ball", "source_tracked")]))


#: Clips of 1,000 orders; a frame's candidates are its lines, roundness from their price.
_FRAMES = """SELECT CAST(floor(o_orderkey / 1000) AS BIGINT) AS clip, o_orderkey AS frame_idx, l_linenumber AS i, l_quantity * 8 AS x, l_discount * 1000 AS y,
 0.4 + l_extendedprice / 200000 AS circ FROM {orders} LEFT JOIN {lineitem} ON l_orderkey = o_orderkey AND (l_orderkey + l_linenumber) % 3 < 2"""


def _query_frames(spark, sf_dir):
    x = spark.sql(_FRAMES, orders=table(spark, sf_dir, "orders"), lineitem=table(spark, sf_dir, "lineitem"))
    one = F.when(F.col("i").isNotNull(), F.struct("i", "x", "y", F.lit(4.0).alias("r"), "circ"))
    # candidates of a frame in a stated order, whatever the lines' order
    return x.groupBy(F.col("clip").cast("string").alias("clip_id"), "frame_idx").agg(F.array_sort(F.collect_list(one)).alias("candidates"))


def ball_track(spark, sf_dir):
    x = track(_query_frames(spark, sf_dir), stretch=128)
    return x.select("clip_id", "frame_idx", "state", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "deformed", "duplicate")


def ball_sequence(spark, sf_dir):
    x = track_scores(track(_query_frames(spark, sf_dir), stretch=128))
    return x.select("clip_id", "frames", "tracked", "teleports", "duplicates", "deformed", F.round("score", 6).alias("score"))


_FRAMES_DUCK = _FRAMES.replace("{orders}", "orders").replace("{lineitem}", "lineitem")
_DIST = "sqrt((c.x - s.px) * (c.x - s.px) + (c.y - s.py) * (c.y - s.py))"
TRACK_SQL = f"""
WITH RECURSIVE c0 AS ({_FRAMES_DUCK}),
f AS MATERIALIZED (SELECT clip, frame_idx, row_number() OVER (PARTITION BY clip ORDER BY frame_idx) AS k, list({{'i': i, 'x': x, 'y': y, 'circ': circ}} ORDER BY i, x, y, circ) FILTER (i IS NOT NULL) AS cs FROM c0 GROUP BY clip, frame_idx),
t(clip, k, px, py, qx, qy, lost, state, best, cs, frame_idx) AS (
 SELECT clip, CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), 0, '', CAST(NULL AS STRUCT(i INTEGER, x DOUBLE, y DOUBLE, circ DOUBLE)), CAST(NULL AS STRUCT(i INTEGER, x DOUBLE, y DOUBLE, circ DOUBLE)[]), CAST(NULL AS BIGINT) FROM (SELECT DISTINCT clip FROM f)
 UNION ALL
 SELECT clip, k, CASE WHEN hit THEN b.x WHEN gone THEN NULL ELSE px END, CASE WHEN hit THEN b.y WHEN gone THEN NULL ELSE py END, CASE WHEN hit THEN px WHEN gone THEN NULL ELSE qx END, CASE WHEN hit THEN py WHEN gone THEN NULL ELSE qy END,
  CASE WHEN hit THEN 0 WHEN px IS NULL THEN 0 ELSE lost + 1 END,
  CASE WHEN hit AND px IS NULL THEN 'start' WHEN hit THEN 'ok' WHEN cs IS NULL THEN 'missing' WHEN px IS NULL THEN 'none' WHEN lost > 0 THEN 'far' ELSE 'teleport' END, CASE WHEN hit THEN b END, cs, frame_idx
 FROM (SELECT *, b IS NOT NULL AND CASE WHEN px IS NULL THEN b.circ >= {ROUND} ELSE d <= {SPEED} * (lost + 1) END AS hit, px IS NOT NULL AND lost + 1 > {LOST} AS gone FROM (
  SELECT s.clip, f.k, s.px, s.py, s.qx, s.qy, s.lost, f.cs, f.frame_idx, o.c AS b, CASE WHEN s.px IS NULL THEN NULL ELSE sqrt((o.c.x - s.px) * (o.c.x - s.px) + (o.c.y - s.py) * (o.c.y - s.py)) END AS d
  FROM t s JOIN f ON f.clip = s.clip AND f.k = s.k + 1 LEFT JOIN LATERAL (SELECT c FROM (SELECT unnest(f.cs) AS c, generate_subscripts(f.cs, 1) AS n) u ORDER BY CASE WHEN s.px IS NULL THEN -c.circ ELSE {_DIST} END, n LIMIT 1) o ON true))),
w AS (SELECT clip, frame_idx, state, best, cs, CASE WHEN px IS NULL OR qx IS NULL THEN 60.0 ELSE greatest(60.0, least(150.0, 1.5 * sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy)))) END AS far FROM t WHERE k > 0),
r AS (SELECT CAST(clip AS VARCHAR) AS clip_id, frame_idx, state, best.x AS x, best.y AS y, coalesce(best.circ < {WHOLE}, false) AS deformed,
 coalesce(len(list_filter(cs, lambda c: c <> best AND sqrt((c.x - best.x) * (c.x - best.x) + (c.y - best.y) * (c.y - best.y)) BETWEEN 8 AND far)) > 0, false) AS duplicate FROM w)"""
QUERIES = {f.__name__: f for f in (ball_track, ball_sequence)}
ORACLES = {
    "ball_track": f"{TRACK_SQL} SELECT clip_id, frame_idx, state, round(x, 6) AS x, round(y, 6) AS y, deformed, duplicate FROM r",
    "ball_sequence": f"""{TRACK_SQL}, n AS (SELECT clip_id, count(*) AS frames, count(x) AS tracked, count_if(state = 'teleport') AS teleports, count_if(duplicate) AS duplicates, count_if(deformed) AS deformed FROM r GROUP BY clip_id)
SELECT *, round(CASE WHEN tracked = 0 THEN 1.0 ELSE greatest(1.0, least(5.0, 5 - least(2.0, duplicates / tracked / 0.15 * 2) - least(1.5, teleports / tracked / 0.15 * 1.5) - least(1.0, deformed / tracked / 0.15)
 - CASE WHEN frames >= 60 AND tracked / frames < 0.08 THEN least(1.5, (0.08 - tracked / frames) / 0.08 * 1.5) ELSE 0 END)) END, 6) AS score FROM n""",
}
