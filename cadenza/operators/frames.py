"""Frame-pair operators on arrays of pixels, as array expressions (no Python on the executors)."""
from pyspark.sql import functions as F

from cadenza.session import table


def scaled(v):
    """A vector as pixels of 0..255."""
    return F.transform(v, lambda x: (x.cast("double") + 1) * 127.5)


def pixels(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("frame_idx"), "label", scaled("embedding").alias("px"))


def mse(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x) / F.size(a)


def mae(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x) / F.size(a)


def psnr(m):
    return F.when(m == 0, 100.0).otherwise(20 * F.log10(255.0 / F.sqrt(m)))


def blend(a, b):
    return F.zip_with(a, b, lambda x, y: 0.5 * x + 0.5 * y)


def source_preservation(spark, sf_dir):
    """Even frame 2k against source frame k."""
    p = pixels(spark, sf_dir)
    s, o = p.select(F.col("frame_idx").alias("k"), F.col("px").alias("a")), p.filter("frame_idx % 2 = 0").select(F.expr("frame_idx div 2").alias("k"), F.col("px").alias("b"))
    x = s.join(o, "k").select("k", mse("a", "b").alias("m"), mae("a", "b").alias("mae"), F.array_max(F.zip_with("a", "b", lambda u, v: F.abs(u - v))).alias("mx"))
    return x.select("k", F.round(psnr(F.col("m")), 5).alias("psnr"), F.round("mae", 5).alias("mae"), F.round("mx", 5).alias("max_diff"), ((psnr(F.col("m")) >= 30) & (F.col("mae") <= 8)).alias("ok"))


def mean_luma(spark, sf_dir):
    p = pixels(spark, sf_dir)
    return p.select("frame_idx", F.round(F.aggregate("px", F.lit(0.0), lambda s, x: s + x) / F.size("px"), 5).alias("luma"))


def luma(r, g, b):
    """BT.709 brightness of three planes of equal size."""
    return F.transform(F.arrays_zip(r.alias("r"), g.alias("g"), b.alias("b")), lambda p: 0.2126 * p["r"] + 0.7152 * p["g"] + 0.0722 * p["b"])


def weighted_luma(spark, sf_dir):
    """Mean brightness of each frame and its two successors as red, green and blue planes."""
    p = pixels(spark, sf_dir).select("frame_idx", "px")
    plane = lambda k, name: p.select((F.col("frame_idx") - k).alias("frame_idx"), F.col("px").alias(name))
    x = plane(0, "r").join(plane(1, "g"), "frame_idx").join(plane(2, "b"), "frame_idx").select("frame_idx", luma(F.col("r"), F.col("g"), F.col("b")).alias("y"))
    return x.select("frame_idx", F.round(F.aggregate("y", F.lit(0.0), lambda s, v: s + v) / F.size("y"), 5).alias("luma"))


def persistent(px, n: int, bright: float, share: float):
    """Aggregate: at how many of n places of an array a value is over `bright` in at least that share of the rows. One sum a place, no row a pixel."""
    return sum(((F.avg((px[i] > bright).cast("double")) >= share).cast("long") for i in range(n)), F.lit(0).cast("long"))


def pixel_persistence(spark, sf_dir):
    return pixels(spark, sf_dir).groupBy("label").agg(persistent(F.col("px"), 64, 135.0, 0.2).alias("n")).filter("n > 0")


def blend_midpoint(spark, sf_dir):
    p = pixels(spark, sf_dir)
    n = p.select((F.col("frame_idx") - 1).alias("frame_idx"), F.col("px").alias("b"))
    x = p.join(n, "frame_idx").select("frame_idx", blend("px", "b").alias("m"))
    return x.select("frame_idx", F.round(F.aggregate("m", F.lit(0.0), lambda s, v: s + v), 4).alias("total"))


QUERIES = {f.__name__: f for f in (source_preservation, mean_luma, weighted_luma, pixel_persistence, blend_midpoint)}
P = "p AS (SELECT vec_id AS frame_idx, label, list_transform(embedding, lambda x: (CAST(x AS DOUBLE) + 1) * 127.5) AS px FROM embeddings)"
ORACLES = {
    "source_preservation": f"WITH {P}, j AS (SELECT s.frame_idx AS k, s.px AS a, o.px AS b FROM p s JOIN p o ON o.frame_idx = 2 * s.frame_idx), u AS (SELECT k, unnest(a) AS x, unnest(b) AS y FROM j), m AS (SELECT k, avg((x - y) * (x - y)) AS m, avg(abs(x - y)) AS mae, max(abs(x - y)) AS mx FROM u GROUP BY k), q AS (SELECT *, CASE WHEN m = 0 THEN 100.0 ELSE 20 * log10(255 / sqrt(m)) END AS ps FROM m) SELECT k, round(ps, 5) AS psnr, round(mae, 5) AS mae, round(mx, 5) AS max_diff, ps >= 30 AND mae <= 8 AS ok FROM q",
    "mean_luma": f"WITH {P} SELECT frame_idx, round(list_avg(px), 5) AS luma FROM p",
    "weighted_luma": f"WITH {P} SELECT r.frame_idx, round(0.2126 * list_avg(r.px) + 0.7152 * list_avg(g.px) + 0.0722 * list_avg(b.px), 5) AS luma FROM p r JOIN p g ON g.frame_idx = r.frame_idx + 1 JOIN p b ON b.frame_idx = r.frame_idx + 2",
    "pixel_persistence": f"WITH {P}, u AS (SELECT label, unnest(px) AS v, generate_subscripts(px, 1) AS pos FROM p), g AS (SELECT label, pos, avg(CAST(v > 135 AS INT)) AS m FROM u GROUP BY 1, 2) SELECT label, count(*) AS n FROM g WHERE m >= 0.2 GROUP BY label",
    "blend_midpoint": f"WITH {P} SELECT a.frame_idx, round(0.5 * list_sum(a.px) + 0.5 * list_sum(b.px), 4) AS total FROM p a JOIN p b ON b.frame_idx = a.frame_idx + 1",
}
