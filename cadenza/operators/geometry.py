"""Joins of points by distance over grid cells, and lines in bundles of like angle; all in the JVM."""
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.session import table

#: A candidate with one this near in the other frame stands still; how far a flying ball goes and how its radius may change.
STILL, NEAR, FAR, RADIUS = 20.0, 25.0, 160.0, 3.5
#: Length of a straight line, angles of a bundle and of one across it, spread that bends a bundle.
LONG, ALIKE, ACROSS, BENT = 70.0, 0.45, 0.30, 0.35


def within(a: DataFrame, b: DataFrame, key: str, reach: float, how: str = "inner") -> DataFrame:
    """Pairs of points a(key, x, y, ...) and b(key, x, y, ...) of equal key at most `reach` apart; b's columns get a 2.

    Points are dealt by key and grid cell, those of b to the nine cells around theirs, so one crowded frame
    is as many groups as it has cells. how: inner, left_semi or left_anti. Points with a null key or
    coordinate are near nothing.
    """
    cell = lambda c: F.floor(F.col(c) / reach).cast("long")
    left = a.withColumns({"cx": cell("x"), "cy": cell("y")})
    around = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    right = b.select(*[F.col(c).alias(f"{c}2") for c in b.columns]).withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around))
    right = right.withColumns({"cx2": F.floor(F.col("x2") / reach).cast("long") + F.col("dx"), "cy2": F.floor(F.col("y2") / reach).cast("long") + F.col("dy")}).drop("dx", "dy")
    apart = F.hypot(F.col("x") - F.col("x2"), F.col("y") - F.col("y2"))
    on = (F.col(key) == F.col(f"{key}2")) & (F.col("cx") == F.col("cx2")) & (F.col("cy") == F.col("cy2")) & (apart <= reach)
    return left.join(right, on, how).drop("cx", "cy", "cx2", "cy2")


def flying_pair(a: DataFrame, b: DataFrame, key: str = "frame_idx") -> DataFrame:
    """Candidates a and b(key, i, x, y, r, circ) of two frames -> (key, ia, ib, score): the roundest pair of each key that may be a ball in flight.

    Left out: candidates with one of the other side nearer than 20, pairs whose radius differs by over 3.5
    or that are not 25 to 160 apart. Of equal scores the smaller (ia, ib) counts.
    """
    strict = lambda x, y: within(x, y, key, STILL, "inner").filter(F.hypot(F.col("x") - F.col("x2"), F.col("y") - F.col("y2")) < STILL).select(F.col(key).alias("k"), F.col("i").alias("j")).distinct()
    free = lambda x, y: x.join(strict(x, y), (F.col(key) == F.col("k")) & (F.col("i") == F.col("j")), "left_anti")
    pairs = within(free(a, b), free(b, a), key, FAR)
    pairs = pairs.filter((F.abs(F.col("r") - F.col("r2")) <= RADIUS) & (F.hypot(F.col("x") - F.col("x2"), F.col("y") - F.col("y2")) >= NEAR))
    best = F.max(F.struct((F.col("circ") * F.col("circ2")).alias("score"), (-F.col("i")).alias("ia"), (-F.col("i2")).alias("ib"))).alias("best")
    return pairs.groupBy(key).agg(best).select(key, (-F.col("best.ia")).alias("ia"), (-F.col("best.ib")).alias("ib"), F.col("best.score").alias("score"))


def ball_mask(ax, ay, bx, by, radius, h: int, w: int):
    """array<boolean> of h x w pixels: those within a ball's radius and 4 of its way from a to b, and 2 more around the middle; null without a ball."""
    whole = lambda c: F.floor(c + 0.5)
    p, q, s, t, r = whole(ax), whole(ay), whole(bx), whole(by), whole(radius + 4)
    mx, my = whole((ax + bx) / 2), whole((ay + by) / 2)
    long = F.greatest((s - p) * (s - p) + (t - q) * (t - q), F.lit(1))

    def inside(i):
        y, x = F.floor(i / w), i % w
        along = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - p) * (s - p) + (y - q) * (t - q)) / long))
        near = F.hypot(x - (p + along * (s - p)), y - (q + along * (t - q))) <= r
        return near | (F.hypot(x - mx, y - my) <= r + 2)

    return F.when(r.isNotNull() & mx.isNotNull() & my.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(h * w - 1)), inside))


def turned(a, b):
    """Distance of two angles of undirected lines."""
    d = F.abs(a - b) % math.pi
    return F.least(d, math.pi - d)


def bundles(lines):
    """array<struct<x1, y1, x2, y2>> -> struct<a, b, misfits, bent>: angles of the long lines in at most two bundles, in the order of the array.

    The first line opens a; a line turned by under 0.45 from it joins a, one about a right angle off joins b,
    any other opens b or joins it if alike; the rest are misfits. bent: bundles of three or more whose angles
    spread by over 0.35. Null and empty arrays give empty bundles.
    """
    at = lambda s, k: s[k].cast("double")
    long = F.filter(lines, lambda s: F.hypot(at(s, "x2") - at(s, "x1"), at(s, "y2") - at(s, "y1")) >= LONG)
    angles = F.transform(long, lambda s: F.pmod(F.atan2(at(s, "y2") - at(s, "y1"), at(s, "x2") - at(s, "x1")), F.lit(math.pi)))
    none = F.array().cast("array<double>")
    angles = F.coalesce(angles, none)

    def put(s, v):
        first = turned(v, F.get(s["a"], F.lit(0)))
        in_a = (F.size(s["a"]) == 0) | (first < ALIKE)
        in_b = ~in_a & ((F.abs(first - math.pi / 2) < ACROSS) | (F.size(s["b"]) == 0) | (turned(v, F.get(s["b"], F.lit(0))) < ALIKE))
        add = lambda k, here: F.when(here, F.concat(s[k], F.array(v))).otherwise(s[k]).alias(k)
        return F.struct(add("a", in_a), add("b", in_b), (s["misfits"] + F.when(in_a | in_b, 0).otherwise(1)).alias("misfits"))

    folded = F.aggregate(angles, F.struct(none.alias("a"), none.alias("b"), F.lit(0).alias("misfits")), put)

    def spread(x):
        mean = F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / F.size(x)
        return F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean)) / F.size(x))

    bent = lambda x: F.when((F.size(x) >= 3) & (spread(x) > BENT), 1).otherwise(0)
    return F.transform(F.array(folded), lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"), s["misfits"].alias("misfits"), (bent(s["a"]) + bent(s["b"])).alias("bent")))[0]


def _box(spark, sf_dir, odd):
    x = table(spark, sf_dir, "lineitem")
    return x.filter(F.col("l_linenumber") % 2 == odd).select(F.col("l_orderkey").alias("frame_idx"), F.col("l_linenumber").cast("long").alias("i"), (F.col("l_quantity") * 10).alias("x"), (F.col("l_discount") * 1000).alias("y"), (F.col("l_tax") * 100).alias("r"), (F.col("l_extendedprice") / 100000).alias("circ"))


def flying_ball(spark, sf_dir):
    """Lines of odd number of an order against those of even number; equal line numbers of an order are one candidate, the largest."""
    one = lambda x: x.groupBy("frame_idx", "i").agg(F.max(F.struct("x", "y", "r", "circ")).alias("c")).select("frame_idx", "i", "c.*")
    x = flying_pair(one(_box(spark, sf_dir, 1)), one(_box(spark, sf_dir, 0)))
    return x.select("frame_idx", "ia", "ib", F.round("score", 6).alias("score"))


def angle_bundles(spark, sf_dir):
    """The lines of an order as drawn lines, in order of their numbers and places."""
    x = table(spark, sf_dir, "lineitem")
    line = F.struct(F.col("l_linenumber").alias("n"), (F.col("l_quantity") * 10).alias("x1"), (F.col("l_discount") * 1000).alias("y1"), (F.col("l_extendedprice") / 100).alias("x2"), (F.col("l_tax") * 4000).alias("y2"))
    x = x.groupBy(F.col("l_orderkey").alias("frame_idx")).agg(F.array_sort(F.collect_list(line)).alias("lines")).select("frame_idx", bundles(F.col("lines")).alias("s"))
    return x.select("frame_idx", F.size("s.a").cast("long").alias("n_a"), F.size("s.b").cast("long").alias("n_b"), F.col("s.misfits").cast("long").alias("misfits"), F.col("s.bent").cast("long").alias("bent"))


_TURN = lambda a, b: f"least(abs({a} - {b}) % pi(), pi() - abs({a} - {b}) % pi())"
QUERIES = {f.__name__: f for f in (flying_ball, angle_bundles)}
ORACLES = {
    "flying_ball": """WITH p AS (SELECT l_orderkey AS frame_idx, CAST(l_linenumber AS BIGINT) AS i, max({'x': l_quantity * 10, 'y': l_discount * 1000, 'r': l_tax * 100, 'circ': l_extendedprice / 100000}) AS c FROM lineitem GROUP BY ALL),
n AS (SELECT p.* FROM p WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.frame_idx = p.frame_idx AND q.i % 2 <> p.i % 2 AND sqrt((p.c.x - q.c.x) * (p.c.x - q.c.x) + (p.c.y - q.c.y) * (p.c.y - q.c.y)) < 20)),
s AS (SELECT a.frame_idx, a.i AS ia, b.i AS ib, a.c.circ * b.c.circ AS score FROM n a JOIN n b ON a.frame_idx = b.frame_idx AND a.i % 2 = 1 AND b.i % 2 = 0 WHERE abs(a.c.r - b.c.r) <= 3.5 AND sqrt((a.c.x - b.c.x) * (a.c.x - b.c.x) + (a.c.y - b.c.y) * (a.c.y - b.c.y)) BETWEEN 25 AND 160)
SELECT frame_idx, ia, ib, round(score, 6) AS score FROM s QUALIFY row_number() OVER (PARTITION BY frame_idx ORDER BY score DESC, ia, ib) = 1""",
    "angle_bundles": f"""WITH RECURSIVE q AS (SELECT l_orderkey AS frame_idx, l_quantity * 10 AS x1, l_discount * 1000 AS y1, l_extendedprice / 100 AS x2, l_tax * 4000 AS y2, l_linenumber AS n FROM lineitem),
v AS MATERIALIZED (SELECT frame_idx, list(((atan2(y2 - y1, x2 - x1) % pi()) + pi()) % pi() ORDER BY n, x1, y1, x2, y2) FILTER (sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) >= 70) AS v FROM q GROUP BY frame_idx),
t(frame_idx, v, k, a, b, misfits) AS (SELECT frame_idx, coalesce(v, []), 1, CAST([] AS DOUBLE[]), CAST([] AS DOUBLE[]), 0 FROM v
 UNION ALL SELECT frame_idx, v, k + 1, CASE WHEN ia THEN list_append(a, v[k]) ELSE a END, CASE WHEN ib THEN list_append(b, v[k]) ELSE b END, misfits + CASE WHEN ia OR ib THEN 0 ELSE 1 END
 FROM (SELECT *, NOT ia AND (abs(f - pi() / 2) < 0.30 OR len(b) = 0 OR {_TURN("v[k]", "b[1]")} < 0.45) AS ib FROM (SELECT *, len(a) = 0 OR f < 0.45 AS ia FROM (SELECT *, {_TURN("v[k]", "a[1]")} AS f FROM t WHERE k <= len(v)))))
SELECT frame_idx, len(a) AS n_a, len(b) AS n_b, CAST(misfits AS BIGINT) AS misfits, CAST(CASE WHEN len(a) >= 3 AND list_stddev_pop(a) > 0.35 THEN 1 ELSE 0 END + CASE WHEN len(b) >= 3 AND list_stddev_pop(b) > 0.35 THEN 1 ELSE 0 END AS BIGINT) AS bent FROM t WHERE k = len(v) + 1""",
}
