"""Frame kernels that need neighbourhoods, labels or flow: numpy on Arrow batches, row by row.

Frames are (h, w) gray or (h, w, 3) RGB arrays. Flow is whole-pixel block matching.
"""
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.frames import scaled
from cadenza.operators.kernels import SIDE, _neighbours, _stack, ssim_arrays
from cadenza.session import table

#: Weights of the four scales.
SCALES = (0.0448, 0.2856, 0.3001, 0.2363)


def ms_ssim_arrays(a, b, least=16):
    """Weighted arithmetic mean of SSIM over up to four scales, each half the last; frames under `least` pixels a side end it."""
    total, weight = np.zeros(len(a)), sum(SCALES)
    for k, w in enumerate(SCALES):
        if k and min(a.shape[1:]) < least:
            break
        total += w / weight * ssim_arrays(a, b)
        h, v = a.shape[1] // 2 * 2, a.shape[2] // 2 * 2
        a, b = ((x[:, :h:2, :v:2] + x[:, 1:h:2, :v:2] + x[:, :h:2, 1:v:2] + x[:, 1:h:2, 1:v:2]) / 4 for x in (a, b))
    return total


def frame_difference(a, b, grid=64):
    """0.6 of the mean distance and 0.4 of the histogram distance (32 bins a channel), on a thinned grid; 0 to 1."""
    a, b = (np.atleast_3d(x)[:: max(1, x.shape[0] // grid), :: max(1, x.shape[1] // grid)].astype(float) for x in (a, b))
    hist = lambda x: np.bincount(np.minimum(x.ravel() // 8, 31).astype(int), minlength=32) / max(1, x.size)
    apart = [1 - np.minimum(hist(a[..., c]), hist(b[..., c])).sum() for c in range(a.shape[2])]
    return float(0.6 * np.abs(a - b).mean() / 255 + 0.4 * np.mean(apart))


def _half(x):
    h, w = x.shape[-2] // 2 * 2, x.shape[-1] // 2 * 2
    return (x[..., :h:2, :w:2] + x[..., 1:h:2, :w:2] + x[..., :h:2, 1:w:2] + x[..., 1:h:2, 1:w:2]) / 4


def flow(a, b, reach=4, half=2, least=24):
    """(h, w, 2) whole-pixel (dy, dx) that take a to b: least block difference, ties to the shortest step. Stacks (n, h, w) give (n, h, w, 2).

    Every step of up to `reach` pixels is tried; frames of `least` pixels a side or more are first searched
    at half their size, and 2 pixels around that answer are tried too. So motion reaches `reach` pixels of
    the smallest size: 4 of an 8 x 8 frame, about 38 of a 160 pixel one.
    """
    if a.ndim == 2:
        return flow(a[None], b[None], reach, half, least)[0]
    n, h, w = a.shape
    a, b, k = a.astype(float), b.astype(float).reshape(n, -1), 2 * half + 1
    y, x = np.mgrid[:h, :w]
    best, out = np.full((n, h, w), np.inf), np.zeros((n, h, w, 2), int)

    def look(start, reach):
        steps = [(dy, dx) for dy in range(-reach, reach + 1) for dx in range(-reach, reach + 1)]
        for dy, dx in sorted(steps, key=lambda s: (s[0] ** 2 + s[1] ** 2, s)):
            at = np.clip(y + start[..., 0] + dy, 0, h - 1) * w + np.clip(x + start[..., 1] + dx, 0, w - 1)
            moved = b[:, at.ravel()] if len(at) == 1 else np.take_along_axis(b, at.reshape(n, -1), 1)
            sums = np.pad(np.abs(a - moved.reshape(n, h, w)), ((0, 0), (half, half), (half, half)), mode="edge").cumsum(1).cumsum(2)
            sums = np.pad(sums, ((0, 0), (1, 0), (1, 0)))
            cost = sums[:, k:, k:] - sums[:, :-k, k:] - sums[:, k:, :-k] + sums[:, :-k, :-k]
            better = cost < best - 1e-9
            best[better], out[better] = cost[better], np.broadcast_to(start + (dy, dx), out.shape)[better]

    look(np.zeros((1, h, w, 2), int), reach)
    if min(h, w) >= least:
        coarse = np.repeat(np.repeat(2 * flow(_half(a), _half(b.reshape(n, h, w)), reach, half, least), 2, axis=1), 2, axis=2)
        look(np.pad(coarse, ((0, 0), (0, h - coarse.shape[1]), (0, w - coarse.shape[2]), (0, 0)), mode="edge"), 2)
    return out


def warp(img, f):
    """img, or each of a stack, read at each pixel plus flow f, bilinear, reflected at the border."""
    h, w = img.shape[-2:]
    mirror = lambda x, n: np.abs((x + n - 1) % (2 * n - 2) - (n - 1)) if n > 1 else x * 0
    y, x = np.mgrid[:h, :w].astype(float)
    y, x = y + f[..., 0], x + f[..., 1]
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    u, v = y - y0, x - x0
    of = (np.arange(len(img))[:, None, None],) if img.ndim == 3 else ()
    at = lambda i, j: img[(*of, mirror(i, h), mirror(j, w))]
    return (1 - u) * ((1 - v) * at(y0, x0) + v * at(y0, x0 + 1)) + u * ((1 - v) * at(y0 + 1, x0) + v * at(y0 + 1, x0 + 1))


def flow_consistency(a, x, b):
    """(mean, p95, boundary mean, magnitude) of x against the middle frame that a and b alone predict; of stacks, an array of each.

    Content moves half its flow from a and half from b; pixels whose two flows disagree by over 3 take the
    better side, as one of them is hidden. x itself has no part in the prediction, so a repeated frame is as
    far from it as the motion makes it. The boundary is where the flow from a to b changes most.
    """
    if a.ndim == 2:
        return tuple(float(v[0]) for v in flow_consistency(a[None], x[None], b[None]))
    n = len(a)
    ab, ba = flow(a, b), flow(b, a)
    pa, pb = warp(a.astype(float), -ab / 2), warp(b.astype(float), -ba / 2)
    hidden = np.hypot(*np.moveaxis((ab + ba).astype(float), -1, 0)) > 3
    ra, rb = np.abs(x - pa), np.abs(x - pb)
    res = np.where(hidden, np.minimum(ra, rb), np.abs(x - (pa + pb) / 2)).reshape(n, -1)
    size = np.hypot(*np.moveaxis(ab.astype(float), -1, 0)).reshape(n, -1)
    edge = sum(np.hypot(*np.gradient(ab[..., k].astype(float), axis=(1, 2))) for k in (0, 1)).reshape(n, -1)
    at = edge >= np.percentile(edge, 85, axis=1, keepdims=True)
    border = np.array([r[k].mean() for r, k in zip(res, at)])
    return res.mean(1), np.percentile(res, 95, axis=1), border, size.mean(1)


def clamp_envelope(a, x, b, margin=10):
    """x held within its neighbours' envelope."""
    lo, hi = np.minimum(a, b).astype(float) - margin, np.maximum(a, b).astype(float) + margin
    return np.clip(x, lo, hi)


def deflicker(frames: DataFrame, margin: float = 10.0) -> DataFrame:
    """frames(clip_id, frame_idx, px) -> inner frames clamped to their neighbours' envelope; first and last stay.

    Neighbours come by equi-joins on frame index, so a long clip is dealt over all tasks.
    """
    side = lambda k, name: frames.select("clip_id", (F.col("frame_idx") + k).alias("frame_idx"), F.col("px").alias(name))
    x = frames.join(side(1, "a"), ["clip_id", "frame_idx"], "left").join(side(-1, "b"), ["clip_id", "frame_idx"], "left")
    near = F.arrays_zip("px", "a", "b")
    held = F.transform(near, lambda p: F.greatest(F.least(p["a"], p["b"]) - margin, F.least(F.greatest(p["a"], p["b"]) + margin, p["px"])))
    return x.select("clip_id", "frame_idx", F.when(F.col("a").isNull() | F.col("b").isNull(), F.col("px")).otherwise(held).alias("px"))


def frame_change(spark, sf_dir):
    @F.pandas_udf("double")
    def f(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([frame_difference(x, y) for x, y in zip(_stack(a, SIDE), _stack(b, SIDE))] if len(a) else [], dtype=float)

    x = _neighbours(spark, sf_dir).select("frame_idx", f("a", "b").alias("d"))
    route = F.when(F.col("d") >= 0.35, "cut").when(F.col("d") >= 0.12, "transition").otherwise("same")
    return x.select("frame_idx", F.round("d", 6).alias("difference"), route.alias("route"))


def _residuals(batches):
    """Triplets in stacks of 256, small enough for the caches."""
    for t in batches:
        for k in range(0, len(t), 256):
            p = t.iloc[k : k + 256]
            m, p95, edge, size = flow_consistency(*(_stack(p[c], SIDE) for c in "abc"))
            yield pd.DataFrame({"frame_idx": p["frame_idx"], "mean": m, "p95": p95, "boundary": edge, "magnitude": size})


def flow_residual(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    # dealt by a fixed number, and before pixels are doubles: vectors are few bytes, and adaptive execution would search a table of many in one task
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    side = lambda k, name: e.select((F.col("vec_id") - k).alias("frame_idx"), F.col("embedding").alias(name)).repartition(tasks, "frame_idx")
    t = side(0, "a").join(side(1, "b"), "frame_idx").join(side(2, "c"), "frame_idx").select("frame_idx", *[scaled(k).alias(k) for k in "abc"])
    x = t.mapInPandas(_residuals, "frame_idx long, mean double, p95 double, boundary double, magnitude double")
    return x.select("frame_idx", *[F.round(k, 5).alias(k) for k in ("mean", "p95", "boundary", "magnitude")])


_P = "p AS (SELECT vec_id AS frame_idx, list_transform(embedding, lambda x: (CAST(x AS DOUBLE) + 1) * 127.5) AS px FROM embeddings)"
QUERIES = {f.__name__: f for f in (frame_change, flow_residual)}
ORACLES = {
    "frame_change": f"""WITH {_P}, j AS (SELECT a.frame_idx, unnest(a.px) AS x, unnest(b.px) AS y FROM p a JOIN p b ON b.frame_idx = a.frame_idx + 1),
l AS (SELECT frame_idx, avg(abs(x - y)) AS l1 FROM j GROUP BY 1), h AS (SELECT frame_idx, bin, sum(a) AS a, sum(b) AS b FROM (SELECT frame_idx, least(floor(x / 8), 31) AS bin, 1 AS a, 0 AS b FROM j UNION ALL SELECT frame_idx, least(floor(y / 8), 31), 0, 1 FROM j) u GROUP BY 1, 2),
s AS (SELECT frame_idx, 1 - sum(least(a, b)) / 64.0 AS hd FROM h GROUP BY 1), d AS (SELECT frame_idx, 0.6 * l1 / 255 + 0.4 * hd AS d FROM l JOIN s USING (frame_idx))
SELECT frame_idx, round(d, 6) AS difference, CASE WHEN d >= 0.35 THEN 'cut' WHEN d >= 0.12 THEN 'transition' ELSE 'same' END AS route FROM d""",
}
