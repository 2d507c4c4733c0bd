"""Joins by distance and bundles of lines against plain loops."""
import math
import random

from pyspark.sql import functions as F

from cadenza.operators import geometry as G

SCHEMA = "frame_idx long, i long, x double, y double, r double, circ double"


def plain_pair(a, b):
    d = lambda p, q: math.hypot(p[2] - q[2], p[3] - q[3])
    out = {}
    for k in {p[0] for p in a}:
        xs, ys = [p for p in a if p[0] == k], [q for q in b if q[0] == k]
        fa = [p for p in xs if all(d(p, q) >= 20 for q in ys)]
        fb = [q for q in ys if all(d(p, q) >= 20 for p in xs)]
        best = [(p[5] * q[5], -p[1], -q[1]) for p in fa for q in fb if abs(p[4] - q[4]) <= 3.5 and 25 <= d(p, q) <= 160]
        if best:
            s, i, j = max(best)
            out[k] = (-i, -j, s)
    return out


def test_flying_pair_equals_plain_loops(spark):
    rng = random.Random(3)
    side = lambda: [(k, i, rng.uniform(-300, 300), rng.uniform(-300, 300), rng.uniform(2, 9), rng.choice([0.5, 0.7, 0.9])) for k in range(40) for i in range(rng.randint(0, 12))]
    a, b = side(), side()
    a += [(99, 1, 0.0, 0.0, 4.0, 0.9), (99, 2, 500.0, 500.0, 4.0, 0.8)]
    b += [(99, 1, 160.0, 0.0, 7.5, 0.9), (99, 2, 519.9, 500.0, 4.0, 0.8), (98, 1, 1.0, 1.0, 1.0, 1.0)]
    frame = lambda x: spark.createDataFrame(x, SCHEMA).repartition(3)
    got = {r.frame_idx: (r.ia, r.ib, r.score) for r in G.flying_pair(frame(a), frame(b)).collect()}
    assert got == plain_pair(a, b) and got[99] == (1, 1, 0.81)
    assert G.flying_pair(frame(a), spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, 1, None, 0.0, 1.0, 1.0), (None, 1, 0.0, 0.0, 1.0, 1.0)], SCHEMA)
    assert G.flying_pair(odd, odd).count() == 0


def test_one_crowded_frame_is_many_groups(spark):
    n = 100_000
    grid = spark.range(n).selectExpr("1L AS frame_idx", "id AS i", "CAST(id % 400 * 40 AS DOUBLE) AS x", "CAST(id div 400 * 40 AS DOUBLE) AS y", "4D AS r", "0.5D + id % 7 / 20 AS circ")
    moved = grid.selectExpr("frame_idx", "i", "x + 20 AS x", "y + 20 AS y", "r", "circ")
    pairs = G.within(grid, moved, "frame_idx", 30.0)
    # inner points meet four neighbours each
    assert pairs.count() == 4 * n - 2 * 400 - 2 * 250 + 1
    assert grid.selectExpr("floor(x / 30) AS c", "floor(y / 30) AS d").distinct().count() > 50_000


def plain_bundles(lines):
    v = [math.atan2(y2 - y1, x2 - x1) % math.pi for x1, y1, x2, y2 in lines or [] if math.hypot(x2 - x1, y2 - y1) >= 70]
    turn = lambda a, b: min(abs(a - b), math.pi - abs(a - b))
    a, b, misfits = v[:1], [], 0
    for x in v[1:]:
        if turn(x, a[0]) < 0.45:
            a.append(x)
        elif abs(turn(x, a[0]) - math.pi / 2) < 0.30 or not b or turn(x, b[0]) < 0.45:
            b.append(x)
        else:
            misfits += 1
    std = lambda x: (sum((p - sum(x) / len(x)) ** 2 for p in x) / len(x)) ** 0.5
    return len(a), len(b), misfits, sum(len(x) >= 3 and std(x) > 0.35 for x in (a, b))


def test_bundles_equal_plain_loops(spark):
    rng = random.Random(5)
    rows = [(k, [tuple(rng.randint(0, 300) for _ in range(4)) for _ in range(rng.randint(0, 14))]) for k in range(300)] + [(998, None), (999, [])]
    d = spark.createDataFrame(rows, "k int, lines array<struct<x1:long,y1:long,x2:long,y2:long>>")
    got = {r.k: (len(r.s.a), len(r.s.b), r.s.misfits, r.s.bent) for r in d.select("k", G.bundles(d.lines).alias("s")).collect()}
    assert got == {k: plain_bundles(x) for k, x in rows}
    assert sum(m for _, _, m, _ in got.values()) and sum(b for *_, b in got.values())


def test_ball_mask(spark):
    d = spark.createDataFrame([(5.2, 6.0, 30.0, 12.0, 1.4), (3.0, 3.0, 3.0, 3.0, 0.0), (None, 1.0, 1.0, 1.0, 1.0)], "ax double, ay double, bx double, by double, r double")
    got = [r.m for r in d.select(G.ball_mask(*[F.col(c) for c in d.columns], 20, 40).alias("m")).collect()]
    assert got[2] is None and len(got[0]) == 800
    for m, (p, q, s, t, r) in zip(got, ((5, 6, 30, 12, 5), (3, 3, 3, 3, 4))):
        for i, v in enumerate(m):
            y, x = divmod(i, 40)
            u = max(0, min(1, ((x - p) * (s - p) + (y - q) * (t - q)) / max(1, (s - p) ** 2 + (t - q) ** 2)))
            mid = (18, 9) if s == 30 else (3, 3)
            assert v == (math.hypot(x - p - u * (s - p), y - q - u * (t - q)) <= r or math.hypot(x - mid[0], y - mid[1]) <= r + 2)
