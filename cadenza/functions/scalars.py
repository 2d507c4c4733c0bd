"""Scalar functions as column expressions; null in, null out unless said otherwise."""
from pyspark.sql import functions as F

from cadenza.session import table


def clamp(x, lo, hi):
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def _round_long(x):
    return F.floor(x + 0.5).cast("long")


def format_timestamp(seconds):
    """HH:MM:SS.mmm; the millisecond carry runs through minutes and hours."""
    ms = _round_long(seconds * 1000)
    at = lambda unit, n: F.floor(ms / unit) % n
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3600000), at(60000, 60), at(1000, 60), ms % 1000)


def format_duration(seconds):
    """MM:SS, or HH:MM:SS from an hour on; rounded to whole seconds."""
    s = _round_long(seconds)
    short = F.format_string("%02d:%02d", F.floor(s / 60), s % 60)
    return F.when(s >= 3600, F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)).otherwise(short)


def time_in_seconds(text):
    """'12.5', 'MM:SS' or 'HH:MM:SS' as seconds; null where a part is no number."""
    return F.aggregate(F.split(F.trim(text), ":"), F.lit(0.0), lambda a, p: a * 60 + p.try_cast("double"))


def fraction(text, default=25.0):
    """'25/1' or '29.97' as a double; the default for a zero denominator or no number."""
    top, bottom = F.split_part(text, F.lit("/"), F.lit(1)), F.split_part(text, F.lit("/"), F.lit(2))
    whole = F.when(bottom == "", top.try_cast("double")).otherwise(F.try_divide(top.try_cast("double"), bottom.try_cast("double")))
    return F.coalesce(whole, F.lit(default))


def id_list(text):
    """'0, 1,2' -> [0, 1, 2]; entries that are no integer are left out."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("int")), lambda x: x.isNotNull())


def ordered_unique(values):
    """Values of an array once each, in the order in which they first stand; nulls and empty texts are left out."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))


def name_paths(text):
    """'a=x,b=y' -> map."""
    return F.str_to_map(text, F.lit(","), F.lit("="))


def colour_class(tags):
    """bt2020, bt601 or bt709 (also for unknown tags) from the text of colour tags."""
    t = F.lower(F.coalesce(tags, F.lit("")))
    return F.when(t.contains("2020"), "bt2020").when(t.rlike("601|470|170m"), "bt601").otherwise("bt709")


def circular_distance(a, b, period):
    d = F.pmod(a - b, F.lit(period))
    return F.least(d, period - d)


def line_distance(px, py, ax, ay, bx, by):
    """Perpendicular distance of a point from the line through two points; from the first where both agree."""
    n = F.hypot(bx - ax, by - ay)
    return F.when(n == 0, F.hypot(px - ax, py - ay)).otherwise(F.abs((bx - ax) * (ay - py) - (ax - px) * (by - ay)) / n)


def line_angle(x1, y1, x2, y2):
    """Direction of a segment, 0 to pi."""
    return F.pmod(F.atan2(y2 - y1, x2 - x1), F.lit(3.141592653589793))


def finite(x, default=0.0):
    """x, or the default for null, NaN and the infinities."""
    return F.when(F.abs(F.nanvl(x, F.lit(float("inf")))) < float("inf"), x).otherwise(F.lit(default))


def every(a, n, first=0):
    """Elements first, first + n, first + 2n ... of an array, in order."""
    return F.filter(a, lambda _, i: (i >= first) & ((i - first) % n == 0))


def entry(m, key, default):
    """Value of a map, or the default."""
    return F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(default))


def missing_of(need, have):
    """What of need is not in have; empty if all is there."""
    return F.array_except(need, have)


def stride_sample(spark, sf_dir):
    """Odd and every fifth place of a vector, and its finite sum."""
    e = table(spark, sf_dir, "embeddings")
    px = F.transform("embedding", lambda x: x.cast("double"))
    add = lambda a: F.round(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), 6)
    return e.select("vec_id", add(every(px, 2, 1)).alias("odd"), add(every(px, 5)).alias("fifth"), finite(F.try_divide(px[0], px[1] - px[1])).alias("ratio"))


def segment_angle(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem")
    a = line_angle(F.lit(0.0), F.lit(0.0), F.col("l_quantity") - 25, F.col("l_tax") * 100 + 1)
    return x.groupBy("l_orderkey").agg(F.round(F.max(a), 6).alias("steepest"), F.round(F.min(circular_distance(a, F.lit(0.0), 3.141592653589793)), 6).alias("flattest"))


def timestamp_text(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", format_timestamp(F.col("value") * 37).alias("stamp"), format_duration(F.col("value") * 37).alias("duration"))


def duration_round_trip(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", time_in_seconds(format_duration(F.col("value") * 37)).alias("seconds"))


def point_line_distance(spark, sf_dir):
    x = line_distance(F.col("l_quantity"), F.col("l_discount") * 100, F.lit(1.0), F.lit(2.0), F.lit(40.0), F.col("l_tax") * 100)
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.round(F.max(x), 5).alias("worst"))


QUERIES = {f.__name__: f for f in (timestamp_text, duration_round_trip, point_line_distance, stride_sample, segment_angle)}
ORACLES = {
    "stride_sample": """WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS px FROM embeddings)
SELECT vec_id, round(list_sum(px[2:64:2]), 6) AS odd, round(list_sum(px[1:64:5]), 6) AS fifth, 0.0 AS ratio FROM p""",
    "segment_angle": """WITH a AS (SELECT l_orderkey, atan2(l_tax * 100 + 1, l_quantity - 25) AS a FROM lineitem)
SELECT l_orderkey, round(max(a), 6) AS steepest, round(min(least(a, pi() - a)), 6) AS flattest FROM a GROUP BY l_orderkey""",
    "timestamp_text": """WITH t AS (SELECT event_id, CAST(floor(value * 37 * 1000 + 0.5) AS BIGINT) AS ms, CAST(floor(value * 37 + 0.5) AS BIGINT) AS s FROM events)
SELECT event_id, printf('%02d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS stamp,
 CASE WHEN s >= 3600 THEN printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) ELSE printf('%02d:%02d', s // 60, s % 60) END AS duration FROM t""",
    "duration_round_trip": "SELECT event_id, CAST(floor(value * 37 + 0.5) AS DOUBLE) AS seconds FROM events",
    "point_line_distance": "SELECT l_orderkey, round(max(abs(39 * (2 - l_discount * 100) - (1 - l_quantity) * (l_tax * 100 - 2)) / sqrt(39 * 39 + (l_tax * 100 - 2) * (l_tax * 100 - 2))), 5) AS worst FROM lineitem GROUP BY l_orderkey",
}
