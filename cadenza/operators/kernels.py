"""Kernels on 2-D frames. Neighbourhood sums are array expressions; filters and transforms that
arrays cannot express well run in numpy on Arrow batches. Frames are arrays in row-major order."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cadenza.operators.frames import pixels

SIDE = 8  # driver vectors hold 64 values, read as 8 x 8 frames


def _mirror(k, n):
    """Border by reflection without repeating the edge."""
    return F.when(k < 0, -k).when(k >= n, 2 * (n - 1) - k).otherwise(k)


def laplacian(px, h=SIDE, w=SIDE):
    """Four-neighbour Laplacian of a row-major array of h*w doubles."""

    def at(i):
        r, c = F.floor(i / w).cast("int"), i % w
        get = lambda y, x: F.get(px, (_mirror(y, h) * w + _mirror(x, w)).cast("int"))
        return get(r - 1, c) + get(r + 1, c) + get(r, c - 1) + get(r, c + 1) - 4 * get(r, c)

    return F.transform(F.sequence(F.lit(0), F.lit(h * w - 1)), at)


def array_variance(a):
    """Population variance, two passes over the array."""
    mean = F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    return F.aggregate(F.transform(a, lambda x: (x - mean) * (x - mean)), F.lit(0.0), lambda s, x: s + x) / F.size(a)


def _gauss(img, taps=11, sigma=1.5):
    k = np.exp(-((np.arange(taps) - taps // 2) ** 2) / (2 * sigma**2))
    k, r = k / k.sum(), taps // 2
    p = np.pad(img, [(0, 0), (r, r), (r, r)], mode="reflect")
    rows = sum(k[i] * p[:, i : i + img.shape[1], :] for i in range(taps))
    return sum(k[i] * rows[:, :, i : i + img.shape[2]] for i in range(taps))


def ssim_arrays(a, b):
    """Mean SSIM of two stacks (n, h, w) of 0..255 frames."""
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
    ma, mb = _gauss(a), _gauss(b)
    va, vb, cov = _gauss(a * a) - ma * ma, _gauss(b * b) - mb * mb, _gauss(a * b) - ma * mb
    s = (2 * ma * mb + c1) * (2 * cov + c2) / ((ma * ma + mb * mb + c1) * (va + vb + c2))
    return s.mean(axis=(1, 2))


def shift_arrays(a, b):
    """Translation (dy, dx) of stack b against a by phase correlation: the centroid of what lies within two pixels of the peak."""
    f = np.fft.fft2(b) * np.conj(np.fft.fft2(a))
    corr = np.fft.ifft2(f / np.maximum(np.abs(f), 1e-12)).real
    h, w = a.shape[1:]
    peak = corr.reshape(len(a), -1).argmax(1)
    y, x = peak // w, peak % w
    ry, rx = (np.arange(-min(2, (n - 1) // 2), min(2, (n - 1) // 2) + 1) for n in (h, w))  # no pixel twice
    near = np.maximum(corr[np.arange(len(a))[:, None, None], (y[:, None] + ry)[:, :, None] % h, (x[:, None] + rx)[:, None, :] % w], 0)
    total = np.maximum(near.sum((1, 2)), 1e-12)
    y, x = np.where(y > h // 2, y - h, y), np.where(x > w // 2, x - w, x)
    return y + (near * ry[:, None]).sum((1, 2)) / total, x + (near * rx).sum((1, 2)) / total


def _stack(s, side):
    return np.stack(s.to_numpy()).astype(float).reshape(len(s), side, side)


def ssim(side=SIDE):
    @F.pandas_udf("double")
    def f(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(ssim_arrays(_stack(a, side), _stack(b, side)) if len(a) else [], dtype=float)

    return f


def motion(side=SIDE):
    @F.pandas_udf("dy double, dx double")
    def f(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        if not len(a):
            return pd.DataFrame({"dy": [], "dx": []}, dtype=float)
        dy, dx = shift_arrays(_stack(a, side), _stack(b, side))
        return pd.DataFrame({"dy": dy, "dx": dx})

    return f


def _neighbours(spark, sf_dir):
    p = pixels(spark, sf_dir).select("frame_idx", F.col("px").alias("a"))
    return p.join(p.select((F.col("frame_idx") - 1).alias("frame_idx"), F.col("a").alias("b")), "frame_idx")


def laplacian_variance(spark, sf_dir):
    x = pixels(spark, sf_dir).withColumn("lap", laplacian(F.col("px")))
    return x.select("frame_idx", F.round(array_variance(F.col("lap")), 4).alias("variance"))


def texture_flicker(spark, sf_dir):
    v = pixels(spark, sf_dir).select("frame_idx", laplacian(F.col("px")).alias("lap")).select("frame_idx", array_variance(F.col("lap")).alias("v1"))
    x = v.join(v.select((F.col("frame_idx") + 1).alias("frame_idx"), F.col("v1").alias("v0")), "frame_idx")
    return x.select("frame_idx", F.round(F.abs(F.col("v1") - F.col("v0")) / (F.col("v1") + F.col("v0") + 1e-5), 6).alias("flicker"))


def diff_heat(spark, sf_dir):
    heat = F.zip_with("a", "b", lambda x, y: F.least(F.lit(255.0), 3 * F.abs(x - y)))
    return _neighbours(spark, sf_dir).select("frame_idx", F.round(F.aggregate(heat, F.lit(0.0), lambda s, x: s + x), 3).alias("heat"))


def frame_ssim(spark, sf_dir):
    return _neighbours(spark, sf_dir).select("frame_idx", F.round(ssim()("a", "b"), 6).alias("ssim"))


def global_motion(spark, sf_dir):
    x = _neighbours(spark, sf_dir).select("frame_idx", motion()("a", "b").alias("m"))
    return x.select("frame_idx", F.round("m.dy", 6).alias("dy"), F.round("m.dx", 6).alias("dx"), F.round(F.hypot("m.dx", "m.dy"), 6).alias("magnitude"))


QUERIES = {f.__name__: f for f in (laplacian_variance, texture_flicker, diff_heat, frame_ssim, global_motion)}
_P = "p AS (SELECT vec_id AS frame_idx, list_transform(embedding, lambda x: (CAST(x AS DOUBLE) + 1) * 127.5) AS px FROM embeddings)"
_U = f"""{_P}, u AS (SELECT frame_idx, px, unnest(range(64)) AS i FROM p), n AS (SELECT frame_idx, px, i // 8 AS r, i % 8 AS c FROM u),
l AS (SELECT frame_idx, px[CASE WHEN r = 0 THEN 1 ELSE r - 1 END * 8 + c + 1] + px[CASE WHEN r = 7 THEN 6 ELSE r + 1 END * 8 + c + 1] + px[r * 8 + CASE WHEN c = 0 THEN 1 ELSE c - 1 END + 1]
 + px[r * 8 + CASE WHEN c = 7 THEN 6 ELSE c + 1 END + 1] - 4 * px[r * 8 + c + 1] AS v FROM n), g AS (SELECT frame_idx, var_pop(v) AS v FROM l GROUP BY frame_idx)"""
ORACLES = {
    "laplacian_variance": f"WITH {_U} SELECT frame_idx, round(v, 4) AS variance FROM g",
    "texture_flicker": f"WITH {_U} SELECT a.frame_idx, round(abs(a.v - b.v) / (a.v + b.v + 1e-5), 6) AS flicker FROM g a JOIN g b ON a.frame_idx = b.frame_idx + 1",
    "diff_heat": f"WITH {_P}, j AS (SELECT a.frame_idx, unnest(a.px) AS x, unnest(b.px) AS y FROM p a JOIN p b ON b.frame_idx = a.frame_idx + 1) SELECT frame_idx, round(sum(least(255.0, 3 * abs(x - y))), 3) AS heat FROM j GROUP BY frame_idx",
}
