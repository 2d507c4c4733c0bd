"""Evaluation of a frame-doubled clip against its source: measured once, scored in one row per clip.

Frames are dealt by (clip, stretch of frames) with the two frames before a stretch repeated, so a
long clip is as many tasks as it has stretches; kernels see each pixel once there. All that follows
are joins on frame index and aggregates over small rows.

Source frame k belongs to output frame 2k; odd output frames are generated. Defined results: a clip
without frames on either side has no row; means over nothing are 0, scores over nothing 5; pixels of
frames are taken as they are stored; flow is block matching on a grid of at most 160 pixels.
"""
from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.operators import detect, geometry, kernels, vision
from cadenza.plans import scoring, selection
from cadenza.session import stored

STRETCH = 16


@dataclasses.dataclass
class Config:
    """Thresholds and strides of an evaluation. sample_stride thins source pairs and triplets alike."""

    max_frames: int | None = None
    sample_stride: int = 1
    source_baseline_stride: int = 5
    min_psnr: float = 30.0
    min_ssim: float = 0.90
    max_mae: float = 8.0
    max_frame_count_diff: int = 5
    max_audio_diff: float = 0.25
    cut: float = 0.35
    target_fps: float = 50.0


BALL = pa.list_(pa.struct([(n, pa.float64()) for n in ("cx", "cy", "r", "circ")]))
PEOPLE = pa.list_(pa.struct([*((n, pa.int64()) for n in "xywh"), ("area", pa.float64()), ("solidity", pa.float64())]))
LINES = pa.list_(pa.struct([(n, pa.int64()) for n in ("x1", "y1", "x2", "y2")]))
NUMBERS = {
    "source": ("psnr", "ssim", "mae", "most", "cut"),
    "frame": ("coverage", "dx", "dy", "motion", "d1", "texture", "top_left", "top_right", "d2", "residual"),
    "counts": ("n_players", "thin", "overlaps", "blurred", "n_lines"),
    "triplet": ("warp", "warp_p95", "boundary", "magnitude", "marking", "bend"),
    "artifact": ("ghosting", "double_contour", "edge_tearing", "deformation"),
}
SCHEMA = pa.schema([
    ("clip_id", pa.string()), ("role", pa.string()), ("frame_idx", pa.int64()),
    *((n, pa.float64()) for k in ("source", "frame", "triplet", "artifact") for n in NUMBERS[k]), *((n, pa.int64()) for n in (*NUMBERS["counts"], "warps", "lines_x")),
    ("hybrid", pa.bool_()), ("has_ball", pa.bool_()), ("balls_a", BALL), ("balls_x", BALL), ("balls_b", BALL), ("people_x", PEOPLE), ("lines", LINES),
    ("goal", pa.struct([(n, pa.int64()) for n in "xywh"])), ("edges_left", pa.binary()), ("edges_right", pa.binary()),
])
DDL = ", ".join(
    f"{f.name} " + {pa.string(): "string", pa.int64(): "long", pa.float64(): "double", pa.bool_(): "boolean", pa.binary(): "binary", BALL: "array<struct<cx:double,cy:double,r:double,circ:double>>",
                    PEOPLE: "array<struct<x:long,y:long,w:long,h:long,area:double,solidity:double>>", LINES: "array<struct<x1:long,y1:long,x2:long,y2:long>>"}.get(f.type, "struct<x:long,y:long,w:long,h:long>")
    for f in SCHEMA)


class Frames:
    """The frames of one stretch; what is derived from a frame is kept for its neighbours."""

    def __init__(self, table: pa.Table):
        self.at, self.own, self.kept = {}, [], {}
        for r in table.to_pylist():
            self.at[r["role"], r["frame_idx"]] = np.frombuffer(r["data"], np.uint8).reshape(r["h"], r["w"], r["c"])
            if r["own"]:
                self.own.append((r["role"], r["frame_idx"]))

    def get(self, role, idx):
        return self.at.get((role, idx))

    def derived(self, name, role, idx):
        key = name, role, idx
        if key not in self.kept:
            f = self.at[role, idx]
            made = {"gray": lambda: detect.gray(f), "green": lambda: detect.green(f), "variance": lambda: float(detect.laplacian(self.derived("gray", role, idx)).var()),
                    "people": lambda: detect.players(f, self.derived("green", role, idx)),
                    "balls": lambda: detect.balls(f, 0.50, self.derived("people", role, idx), (), self.derived("green", role, idx)),
                    "lines": lambda: detect.segments(detect.line_mask(f, self.derived("green", role, idx)))}
            self.kept[key] = made[name]()
        return self.kept[key]


def corner_boxes(h, w):
    """Where score and logo stand: rows and columns of the upper corners."""
    return (slice(0, int(h * 0.18)), slice(0, int(w * 0.30))), (slice(0, int(h * 0.15)), slice(int(w * 0.75), int(w * 0.98)))


def source_row(x: Frames, t: int, c: Config) -> dict:
    """Frame t/2 of the source against output frame t, and the cut that may lie before it."""
    f, k, out = x.get("s", t), t // 2, {}
    shown = x.get("o", t)
    if shown is not None and shown.shape == f.shape:
        d = np.abs(f.astype(float) - shown)
        mse = float((d * d).mean())
        out |= {"psnr": 100.0 if mse == 0 else float(20 * np.log10(255 / np.sqrt(mse))), "mae": float(d.mean()), "most": float(d.max())}
        out["ssim"] = float(kernels.ssim_arrays(x.derived("gray", "s", t)[None], x.derived("gray", "o", t)[None])[0])
    before = x.get("s", t - 2)
    if before is not None and before.shape == f.shape:
        cut = vision.frame_difference(before, f)
        out["cut"] = cut
        between = x.get("o", t - 1)
        if cut >= c.cut and between is not None and between.shape == f.shape:
            mean = ((before.astype(float) + f) / 2).astype(np.uint8)
            a, b, m = (vision.frame_difference(between, y) for y in (before, f, mean))
            out["hybrid"] = a > 0.20 and b > 0.20 or m < 0.12
    if k % c.source_baseline_stride == 0:
        out |= detect.artifacts(x.derived("gray", "s", t)) | {"has_ball": bool(x.derived("balls", "s", t))}
    return out


def output_row(x: Frames, t: int) -> dict:
    """Output frame t, its step from t-1 and t-2, and the triplet around t-1 if that frame is generated."""
    f, g, mask = x.get("o", t), x.derived("gray", "o", t), x.derived("green", "o", t)
    cover = detect.coverage(mask)
    out = {"coverage": cover}
    corners = corner_boxes(*g.shape)
    if cover >= detect.PITCH_SHARE:
        people = x.derived("people", "o", t)
        seen, blurred = detect.occlusions(g, people)
        lines = x.derived("lines", "o", t)
        out |= {"n_players": len(people), "thin": sum(p["solidity"] < 0.45 for p in people), "overlaps": seen, "blurred": blurred, "n_lines": len(lines), "lines": lines}
    if t % 25 == 0:
        out["goal"] = detect.goal(f)
    if x.get("o", t - 1) is None:
        return out
    p = x.derived("gray", "o", t - 1)
    dy, dx = kernels.shift_arrays(p[None], g[None])
    now, last = x.derived("variance", "o", t), x.derived("variance", "o", t - 1)
    out |= {"dx": float(dx[0]), "dy": float(dy[0]), "motion": float(np.hypot(dx[0], dy[0])), "d1": float(np.abs(g - p).mean()), "texture": abs(now - last) / (now + last + 1e-5)}
    for name, box in zip(("left", "right"), corners):
        out[f"top_{name}"] = float(np.abs(g[box] - p[box]).mean())
        if t % 10 == 0:
            out[f"edges_{name}"] = np.packbits(detect.edges(g[box], 80, 180)).tobytes()
    if x.get("o", t - 2) is None:
        return out
    q = x.derived("gray", "o", t - 2)
    out |= {"d2": float(np.abs(g - q).mean()), "residual": float(np.abs(p - (g + q) / 2).mean())}
    if t % 2 == 0:
        a, m, b = (x.get("o", i) for i in (t - 2, t - 1, t))
        step = -(-max(g.shape) // 160)
        mean, p95, edge, size = vision.flow_consistency(*(z[::step, ::step] for z in (q, p, g)))
        out |= {"warp": mean, "warp_p95": p95, "boundary": edge, "magnitude": size * step} | detect.artifacts(p)
        inner = x.derived("green", "o", t - 1)
        on = detect.coverage(inner) >= detect.PITCH_SHARE
        people = x.derived("people", "o", t - 1) if on else []
        lines = x.derived("lines", "o", t - 1) if on else []
        out |= {"balls_a": x.derived("balls", "o", t - 2), "balls_b": x.derived("balls", "o", t), "balls_x": detect.balls(m, 0.35, people, lines, inner), "people_x": people}
        pitch = detect.pitch_triplet(a, m, b, vision.frame_difference(a, b))
        if pitch:
            out |= {"marking": pitch["residual"], "warps": pitch["warps"], "bend": pitch["bend"], "lines_x": pitch["lines"]}
    return out


def measure(source: DataFrame, output: DataFrame, config: Config = Config(), stretch: int = STRETCH) -> DataFrame:
    """frames(clip_id, frame_idx, h, w, c, data) of both sides -> one row of measures per frame (role s or o; s at twice its index)."""
    cols = ["h", "w", "c", "data"]
    u = source.select("clip_id", (2 * F.col("frame_idx")).alias("frame_idx"), F.lit("s").alias("role"), *cols).unionByName(output.select("clip_id", "frame_idx", F.lit("o").alias("role"), *cols))
    if config.max_frames:
        u = u.filter(F.col("frame_idx") < 2 * config.max_frames)
    if (every := config.sample_stride) > 1:  # whole triplets, and the source frames on both of their ends
        u = u.filter((F.floor(F.col("frame_idx") / 2) % every == 0) | (F.col("frame_idx") % (2 * every) == 2))
    b = F.floor(F.col("frame_idx") / stretch)
    spread = F.when(F.col("frame_idx") % stretch >= stretch - 2, F.array(b, b + 1)).otherwise(F.array(b))
    u = u.withColumn("own_stretch", b).withColumn("stretch", F.explode(spread)).withColumn("own", F.col("own_stretch") == F.col("stretch"))

    def run(table: pa.Table) -> pa.Table:
        x = Frames(table)
        clip = table.column("clip_id")[0].as_py()
        rows = [{"clip_id": clip, "role": role, "frame_idx": t} | (source_row(x, t, config) if role == "s" else output_row(x, t)) for role, t in sorted(x.own)]
        return pa.Table.from_pylist(rows, schema=SCHEMA)

    return u.groupBy("clip_id", "stretch").applyInArrow(run, DDL)


# -- the ball in a triplet, on candidate arrays ----------------------------------------------------------


def _best(candidates, better):
    """The first element that no later one beats."""
    return F.aggregate(F.slice(candidates, 2, F.greatest(F.size(candidates) - 1, F.lit(0))), candidates[0], lambda a, c: F.when(better(c, a), c).otherwise(a))


def ball_triplets(rows: DataFrame) -> DataFrame:
    """rows(balls_a, balls_x, balls_b, people_x, ...) -> + active, matched, occluded, dissolved, wobble, deformed, duplicate."""
    both = (F.size("balls_a") > 0) & (F.size("balls_b") > 0)
    rounder = lambda c, a: c["circ"] > a["circ"]
    x = rows.withColumns({"a": F.when(both, _best(F.col("balls_a"), rounder)), "b": F.when(both, _best(F.col("balls_b"), rounder))})
    x = x.withColumn("apart", F.hypot(F.col("b.cx") - F.col("a.cx"), F.col("b.cy") - F.col("a.cy")))
    x = x.withColumn("active", F.coalesce(F.col("apart") <= 160, F.lit(False)))
    x = x.withColumns({"ex": (F.col("a.cx") + F.col("b.cx")) / 2, "ey": (F.col("a.cy") + F.col("b.cy")) / 2})
    far = lambda c: F.hypot(c["cx"] - F.col("ex"), c["cy"] - F.col("ey"))
    near = F.filter("balls_x", lambda c: far(c) <= F.greatest(F.lit(20.0), F.col("apart") * 0.55 + 10))
    x = x.withColumn("near", near).withColumn("m", F.when(F.col("active") & (F.size("near") > 0), _best(F.col("near"), lambda c, a: far(c) < far(a))))
    x = x.withColumn("matched", F.col("m").isNotNull())
    hidden = F.exists("people_x", lambda p: F.col("ex").between(p["x"] - 10, p["x"] + p["w"] + 10) & F.col("ey").between(p["y"] - 10, p["y"] + p["h"] + 10))
    x = x.withColumn("occluded", F.col("active") & ~F.col("matched") & F.coalesce(hidden, F.lit(False)))
    ux, uy = ((F.col(f"b.{k}") - F.col(f"a.{k}")) / (F.col("apart") + 1e-6) for k in ("cx", "cy"))
    along = lambda c: (c["cx"] - F.col("a.cx")) * ux + (c["cy"] - F.col("a.cy")) * uy
    aside = lambda c: F.abs((c["cx"] - F.col("a.cx")) * uy - (c["cy"] - F.col("a.cy")) * ux)
    m = F.col("m")
    ghost = F.exists("balls_x", lambda c: (c["circ"] >= 0.55) & along(c).between(-10, F.col("apart") + 10) & (aside(c) <= 12) & (F.hypot(c["cx"] - m["cx"], c["cy"] - m["cy"]) >= 8))
    no = lambda c: F.coalesce(c, F.lit(False))
    return x.withColumns({
        "dissolved": F.col("active") & ~F.col("matched") & ~F.col("occluded"),
        "wobble": no(F.col("matched") & (F.col("apart") > 8) & (aside(m) > 8)),
        "deformed": no(F.col("matched") & (m["circ"] < 0.60) & ((F.col("a.circ") >= 0.65) | (F.col("b.circ") >= 0.65))),
        "duplicate": no(F.col("matched") & (F.col("apart") >= 8) & ghost),
    }).drop("a", "b", "m", "near", "ex", "ey", "apart")


# -- one row a clip --------------------------------------------------------------------------------------


def mean(c, default=0.0):
    return F.coalesce(F.avg(c), F.lit(float(default)))


def temporal(m: DataFrame) -> DataFrame:
    """clip_id, smoothness, flicker and the like, from the steps between output frames."""
    o = m.filter("role = 'o'").select("clip_id", "frame_idx", "dx", "dy", "motion", "d1", "d2", "texture", "residual", "warp", "boundary", "magnitude")
    nxt = o.filter("dx is not null").select("clip_id", (F.col("frame_idx") - 1).alias("frame_idx"), F.col("dx").alias("dx2"), F.col("dy").alias("dy2"), F.col("motion").alias("motion2"))
    x = o.join(nxt, ["clip_id", "frame_idx"], "left").withColumn("acc", F.hypot(F.col("dx2") - F.col("dx"), F.col("dy2") - F.col("dy")))
    broken = (F.col("acc") > 2.5 * F.greatest(F.lit(1.0), (F.col("motion") + F.col("motion2")) / 2)) & (F.col("acc") > 3)
    pan = o.groupBy("clip_id").agg(mean("motion").alias("pan"))
    jerky = x.join(pan, "clip_id").groupBy("clip_id").agg(F.count_if(F.col("acc") > F.greatest(F.lit(2.5), 1.5 * F.col("pan"))).alias("jerks"))
    t = x.groupBy("clip_id").agg(
        F.count("*").alias("n_output"), F.count("dx").alias("vectors"), F.count_if(broken).alias("breaks"), mean("acc").alias("acceleration"), mean("texture").alias("texture"),
        F.coalesce(F.avg("residual"), F.avg("d1"), F.lit(0.0)).alias("residual"), mean(F.col("d1") / (F.col("d2") + 1), 1).alias("oscillation"), mean("warp").alias("warp"),
        mean("boundary").alias("boundary"), mean("magnitude").alias("magnitude"))
    p95 = selection.percentile(o, ["clip_id"], "warp", 0.95, name="warp_p95")
    t = t.join(jerky, "clip_id").join(p95, "clip_id", "left").na.fill(0.0, ["warp_p95"])
    t = t.withColumns({"smoothness": scoring.smoothness(F.col("breaks"), F.col("vectors"), F.col("acceleration")), "flicker": 0.15 * F.col("residual") + 3.5 * F.col("texture")})
    return t.withColumns({"temporal_status": scoring.temporal_status(F.col("smoothness"), F.col("warp")), "temporal": scoring.stability(F.col("smoothness"), F.col("flicker")), "camera": scoring.camera(F.col("jerks"), F.col("vectors"))})


def preservation(m: DataFrame, c: Config) -> DataFrame:
    """Source frames against their output frames, cuts and artifact baseline."""
    s = m.filter("role = 's'").groupBy("clip_id").agg(
        F.count("*").alias("n_source"), mean("psnr").alias("psnr"), mean("ssim").alias("ssim"), mean("mae").alias("mae"), F.coalesce(F.max("most"), F.lit(0.0)).alias("max_diff"),
        F.count_if(F.col("cut") >= c.cut).alias("cuts"), F.count_if(F.col("hybrid")).alias("hybrids"), F.count_if("has_ball").alias("source_balls"), *[mean(k).alias(f"source_{k}") for k in NUMBERS["artifact"]])
    kept = (F.col("psnr") >= c.min_psnr) & (F.col("ssim") >= c.min_ssim) & (F.col("mae") <= c.max_mae)
    return s.withColumns({"preserved": kept, "cuts_ok": (F.col("hybrids") == 0) | (F.col("hybrids") <= 2) & (F.col("cuts") >= 5)})


def artifact_differential(m: DataFrame) -> DataFrame:
    """Artifact levels of generated frames, and double contours by how fast the picture moves (an empty class has the mean of all)."""
    x = m.filter("role = 'o' and ghosting is not null")
    speed = F.when(F.col("magnitude") < 3, "low").when(F.col("magnitude") < 10, "med").when(F.col("magnitude") < 25, "high").otherwise("very_high")
    by = [F.coalesce(F.avg(F.when(speed == k, F.col("double_contour"))), F.avg("double_contour")).alias(f"{k}_motion_added") for k in ("low", "med", "high", "very_high")]
    return x.groupBy("clip_id").agg(*[mean(k).alias(f"output_{k}") for k in NUMBERS["artifact"]], *by)


def on_pitch(m: DataFrame) -> DataFrame:
    """Ball, player, occlusion and pitch scores."""
    o = m.filter("role = 'o'")
    flags = ("active", "matched", "dissolved", "wobble", "deformed", "duplicate", "occluded")
    x = ball_triplets(o)
    x = x.groupBy("clip_id").agg(
        mean(F.when(F.col("frame_idx") % 10 == 0, F.col("coverage"))).alias("pitch_share"), *[F.count_if(k).alias(f"ball_{k}") for k in flags],
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("n_players", "thin", "overlaps", "blurred", "warps", "lines_x")], mean("marking").alias("marking"), F.count("marking").alias("pitch_triplets"))
    c = F.col
    here = c("pitch_share") >= detect.PITCH_SHARE
    b = [c(f"ball_{k}") for k in ("active", "matched", "dissolved", "duplicate", "wobble", "deformed")]
    return x.withColumns({"ball": scoring.ball(here, *b), "player": scoring.player(c("thin"), c("n_players")), "occlusion": scoring.occlusion(c("blurred"), c("overlaps")),
                          "pitch": scoring.pitch(here, c("marking"), c("warps"), c("pitch_triplets"))})


def goal_net(m: DataFrame, output: DataFrame) -> DataFrame:
    """Texture of the net inside the last goal seen, frames at even against frames at odd places from the first on."""
    seen = m.filter("role = 'o' and frame_idx % 25 = 0").select("clip_id", F.expr("frame_idx div 25").alias("block"), "goal", F.when(F.col("goal").isNotNull(), F.col("frame_idx")).alias("first"))
    # one small row per 25 frames
    upto = W.partitionBy("clip_id").orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    roi = seen.select("clip_id", "block", F.last("goal", True).over(upto).alias("goal"), F.min("first").over(upto).alias("first")).filter("goal is not null")
    x = output.withColumn("block", F.expr("frame_idx div 25")).join(roi, ["clip_id", "block"])

    def run(batches):
        for b in batches:
            rows = b.to_pylist()
            out = [detect.net_texture(detect.gray(np.frombuffer(r["data"], np.uint8).reshape(r["h"], r["w"], r["c"])), r["goal"]) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r["clip_id"] for r in rows], pa.string()), pa.array([(r["frame_idx"] - r["first"]) % 2 for r in rows], pa.int64()), pa.array(out, pa.float64())], ["clip_id", "odd", "v"])

    v = x.select("clip_id", "frame_idx", "first", "goal", "h", "w", "c", "data").mapInArrow(run, "clip_id string, odd long, v double").filter("v is not null")
    g = v.groupBy("clip_id").agg(mean(F.when(F.col("odd") == 0, F.col("v"))).alias("even_net"), mean(F.when(F.col("odd") == 1, F.col("v"))).alias("odd_net"), F.count("*").alias("net_frames"))
    return g.withColumn("goal_net", scoring.goal(F.col("even_net"), F.col("odd_net"), F.col("net_frames")))


def graphics(m: DataFrame, group: int = 1000) -> DataFrame:
    """Jitter of the corners whose edges stand still; a pixel's counts are summed in groups of frames, then over these."""
    e = m.filter("role = 'o'").unpivot(["clip_id", "frame_idx"], ["edges_left", "edges_right"], "corner", "bits").filter("bits is not null")

    def add(table: pa.Table) -> pa.Table:
        counts = [np.unpackbits(np.frombuffer(b.as_py(), np.uint8)).astype(np.int64) for b in table.column("bits")] if "bits" in table.column_names else [np.array(b.as_py()) for b in table.column("counts")]
        n = len(counts) if "bits" in table.column_names else sum(table.column("n").to_pylist())
        size = max(map(len, counts))
        total = sum(np.pad(c, (0, size - len(c))) for c in counts)
        return pa.table({"clip_id": [table.column("clip_id")[0].as_py()], "corner": [table.column("corner")[0].as_py()], "n": pa.array([n], pa.int64()), "counts": pa.array([total.tolist()], pa.list_(pa.int64()))})

    kind = "clip_id string, corner string, n long, counts array<long>"
    part = e.withColumn("g", F.expr(f"frame_idx div {group * 10}")).groupBy("clip_id", "corner", "g").applyInArrow(add, kind)
    still = part.groupBy("clip_id", "corner").applyInArrow(add, kind)
    fixed = F.size(F.filter("counts", lambda k: k >= 0.60 * F.col("n")))
    still = still.filter((F.col("n") >= 5) & (fixed >= 40)).select("clip_id", "corner")
    d = m.filter("role = 'o'").groupBy("clip_id").agg(mean("top_left").alias("edges_left"), mean("top_right").alias("edges_right")).unpivot("clip_id", ["edges_left", "edges_right"], "corner", "jitter")
    x = d.join(still, ["clip_id", "corner"]).groupBy("clip_id").agg(F.avg("jitter").alias("jitter"))
    return x.withColumn("graphics", scoring.graphics(F.col("jitter")))


def football(output: DataFrame, config: Config = Config()) -> DataFrame:
    """Ball, player, occlusion, pitch, goal and graphics results of clips without a source; one row per clip."""
    m = stored(measure(output.limit(0), output, config))
    x = on_pitch(m)
    for part in (goal_net(m, output), graphics(m)):
        x = x.join(part, "clip_id", "left")
    return x.na.fill(5.0, ["goal_net", "graphics"]).na.fill(0.0, ["jitter"])


def technical(source_meta: DataFrame, output_meta: DataFrame, c: Config) -> DataFrame:
    """meta(clip_id, nominal_fps, avg_fps, duration, nb_frames, audio array<struct<duration, channels, sample_rate>>) of both sides -> checks and warnings."""
    side = lambda m, p: m.select("clip_id", *[F.col(k).alias(f"{p}_{k}") for k in ("nominal_fps", "avg_fps", "duration", "nb_frames", "audio")])
    x = side(source_meta, "s").join(side(output_meta, "o"), "clip_id")
    col, has = F.col, lambda p: F.coalesce(F.size(f"{p}_audio") > 0, F.lit(False))
    expected = F.when(col("s_nb_frames") > 0, 2 * col("s_nb_frames") - 1).when(col("s_duration") > 0, F.rint(col("s_duration") * c.target_fps).cast("long")).otherwise(0)
    x = x.withColumns({"expected_frames": expected, "sound": F.nullif(F.get("s_audio", F.lit(0))["duration"], F.lit(0.0)), "sound_out": F.nullif(F.get("o_audio", F.lit(0))["duration"], F.lit(0.0))})
    x = x.withColumns({
        "fps_ok": (F.abs(col("o_nominal_fps") - c.target_fps) <= 1) | (F.abs(col("o_avg_fps") - c.target_fps) <= 1), "frame_diff": col("o_nb_frames") - col("expected_frames"),
        "audio_diff": F.when(has("s") & has("o"), F.abs(F.coalesce("sound_out", "o_duration") - F.coalesce("sound", "s_duration"))).otherwise(0.0),
        "drift": F.when(has("s") & has("o"), F.abs(F.coalesce("sound_out", "o_duration") - col("o_duration"))).otherwise(0.0),
    })
    x = x.withColumns({"frames_ok": F.abs("frame_diff") <= c.max_frame_count_diff, "audio_ok": ~(has("s") & ~has("o")) & (col("audio_diff") <= c.max_audio_diff)})
    differ = lambda k: has("s") & has("o") & (F.get("s_audio", F.lit(0))[k] != F.get("o_audio", F.lit(0))[k])
    says = ((~col("fps_ok"), "output rate is off"), (~col("frames_ok"), "frames are missing or extra"), (has("s") & ~has("o"), "audio is missing"), (col("audio_diff") > c.max_audio_diff, "audio duration differs"),
            (col("drift") > c.max_audio_diff, "audio drifts from video"), (differ("channels"), "channel count changed"), (differ("sample_rate"), "sample rate changed"))
    return x.withColumn("warnings", F.array_compact(F.array(*[F.when(w, F.lit(text)) for w, text in says]))).select("clip_id", "expected_frames", "fps_ok", "frame_diff", "frames_ok", "audio_diff", "audio_ok", "warnings", F.col("s_duration").alias("source_duration"))


def validate(meta: DataFrame, expected: DataFrame, fps: float = 50.0, most: int = 5) -> DataFrame:
    """meta of outputs, expected(clip_id, frames, sound) -> clip_id, valid and errors: rate within 0.5, frames within `most`, sound where it is expected."""
    c = F.col
    x = meta.join(expected.select(c("clip_id").alias("of_clip"), "frames", "sound"), c("clip_id").eqNullSafe(c("of_clip")))
    rate = F.when(c("nominal_fps") > 0, c("nominal_fps")).otherwise(c("avg_fps"))
    says = ((F.abs(rate - fps) > 0.5, "rate"), (c("sound") & (F.coalesce(F.size("audio"), F.lit(0)) <= 0), "audio"), (F.abs(c("nb_frames") - c("frames")) > most, "frames"))
    x = x.withColumn("errors", F.array_compact(F.array(*[F.when(F.coalesce(w, F.lit(True)), F.lit(t)) for w, t in says])))
    return x.select("clip_id", (F.size("errors") == 0).alias("valid"), "errors")


def pts_checks(pts: DataFrame, stretch: float = 60.0) -> DataFrame:
    """pts(clip_id, pts_time) -> duplicates and gaps over 80 ms between neighbours in time.

    A clip is ordered by stretches of time; the last stamp of one meets the first of the next that has any.
    """
    x = pts.filter("pts_time is not null").select("clip_id", F.col("pts_time").alias("t"), F.floor(F.col("pts_time") / stretch).alias("part"))
    first = x.groupBy("clip_id", "part").agg(F.min("t").alias("first"))
    after = first.select(F.col("clip_id").alias("of_clip"), F.col("part").alias("of_part"), F.lead("first").over(W.partitionBy("clip_id").orderBy("part")).alias("after"))  # one row a stretch
    x = x.join(after, F.col("clip_id").eqNullSafe(F.col("of_clip")) & (F.col("part") == F.col("of_part")))
    gap = F.coalesce(F.lead("t").over(W.partitionBy("clip_id", "part").orderBy("t")), F.col("after")) - F.col("t")
    x = x.select("clip_id", gap.alias("gap")).groupBy("clip_id").agg(F.count_if(F.col("gap") == 0).alias("pts_duplicates"), F.count_if(F.col("gap") > 0.08).alias("pts_gaps"))
    return x.withColumn("pts_ok", (F.col("pts_duplicates") == 0) & (F.col("pts_gaps") == 0))


def pitch_sequence(m: DataFrame) -> DataFrame:
    """Measured output frames -> lines, misfits and bent bundles, sudden changes of their number, and a score a clip."""
    o = m.filter("role = 'o'").select("clip_id", "frame_idx", F.coalesce(F.size("lines"), F.lit(0)).alias("n"), geometry.bundles(F.col("lines")).alias("s"))
    last = o.select(F.col("clip_id").alias("of_clip"), (F.col("frame_idx") + 1).alias("next"), F.col("n").alias("n1"))
    x = o.join(last, F.col("clip_id").eqNullSafe(F.col("of_clip")) & (F.col("frame_idx") == F.col("next")), "left")
    x = x.groupBy("clip_id").agg(F.count("*").alias("frames"), F.sum("n").alias("lines"), F.sum(F.col("s.misfits") + F.col("s.bent")).alias("wobbles"), F.count_if(F.abs(F.col("n") - F.col("n1")) >= 3).alias("drops"))
    return x.withColumn("pitch_sequence", scoring.pitch_sequence(F.col("frames"), F.col("wobbles"), F.col("drops")))


def ground_truth(truth: DataFrame, output: DataFrame, max_frames: int | None = None) -> DataFrame:
    """True frames at the output's rate against generated (odd) frames of equal index -> psnr, ssim, ms_ssim, mae, mse, most and n a clip.

    max_frames: generated frames of each clip, from the first on. Frames of different shapes are left out.
    """
    cols = ("h", "w", "c", "data")
    t = truth.select(F.col("clip_id").alias("of_clip"), F.col("frame_idx").alias("at"), *[F.col(k).alias(f"{k}2") for k in cols])
    x = output.filter("frame_idx % 2 = 1" + (f" and frame_idx < {2 * max_frames}" if max_frames else ""))
    x = x.join(t, F.col("clip_id").eqNullSafe(F.col("of_clip")) & (F.col("frame_idx") == F.col("at"))).filter("h = h2 and w = w2 and c = c2")
    names = ("psnr", "ssim", "ms_ssim", "mae", "mse", "most")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                a, b = (np.frombuffer(r[k], np.uint8).reshape(r["h"], r["w"], r["c"]) for k in ("data2", "data"))
                d = np.abs(a.astype(float) - b)
                mse = float((d * d).mean())
                g, k = detect.gray(a)[None], detect.gray(b)[None]
                psnr = 100.0 if mse == 0 else float(20 * np.log10(255 / np.sqrt(mse)))
                row = (psnr, float(kernels.ssim_arrays(g, k)[0]), float(vision.ms_ssim_arrays(g, k)[0]), float(d.mean()), mse, float(d.max()))
                yield pa.RecordBatch.from_pylist([{"clip_id": r["clip_id"], **dict(zip(names, row))}], schema=pa.schema([("clip_id", pa.string()), *((n, pa.float64()) for n in names)]))

    x = x.select("clip_id", "h", "w", "c", "data", "data2").mapInArrow(run, "clip_id string, " + ", ".join(f"{n} double" for n in names))
    return x.groupBy("clip_id").agg(*[F.avg(n).alias(n) for n in names[:5]], F.max("most").alias("most"), F.count("*").alias("n"))


def evaluate(source: DataFrame, output: DataFrame, source_meta: DataFrame, output_meta: DataFrame, pts: DataFrame | None = None, survey: DataFrame | None = None, timing: DataFrame | None = None, config: Config = Config(), measured: DataFrame | None = None) -> DataFrame:
    """One row per clip: technical, temporal, on-pitch and perceptual results, quality, performance and recommendation.

    pts(clip_id, pts_time), survey(clip_id, score) and timing(clip_id, seconds) are optional; without
    a survey the mean of six scores stands for it and has no weight, without timing performance is left open.
    measured: what measure() gave and stored() wrote, if that is there already.
    """
    m = measured if measured is not None else stored(measure(source, output, config))
    x = preservation(m, config)
    for part in (temporal(m), on_pitch(m), artifact_differential(m), goal_net(m, output), graphics(m), technical(source_meta, output_meta, config)):
        x = x.join(part, "clip_id", "left")
    none = lambda names: x.select("clip_id").limit(0).selectExpr("clip_id", *names)
    x = x.join(pts_checks(pts) if pts is not None else none(["0L AS pts_duplicates", "0L AS pts_gaps", "true AS pts_ok"]), "clip_id", "left")
    x = x.join(survey.select("clip_id", F.col("score").cast("double").alias("survey")) if survey is not None else none(["CAST(NULL AS DOUBLE) AS survey"]), "clip_id", "left")
    x = x.join(timing.select("clip_id", F.col("seconds").cast("double")) if timing is not None else none(["CAST(NULL AS DOUBLE) AS seconds"]), "clip_id", "left")
    c = F.col
    x = x.na.fill(5.0, ["goal_net", "graphics"]).na.fill(0.0, ["jitter"]).na.fill(True, ["pts_ok"]).na.fill(0, ["pts_duplicates", "pts_gaps"])
    heard = F.coalesce("warnings", F.array().cast("array<string>"))
    more = ((c("psnr") < config.min_psnr, "PSNR of source frames is low"), (c("psnr").between(config.min_psnr, 34.999999), "source frames were lossily encoded"), (c("ssim") < config.min_ssim, "SSIM of source frames is low"),
            (c("mae") > config.max_mae, "source frames differ"), (~c("pts_ok"), "time stamps have gaps or repeat"), (c("hybrids") > 0, "blends of two scenes at cuts"))
    x = x.withColumn("warnings", F.concat(heard, F.array_compact(F.array(*[F.when(w, F.lit(t)) for w, t in more]))))
    failed = ~(c("preserved") & F.coalesce("fps_ok", F.lit(True)) & F.coalesce("audio_ok", F.lit(True)) & c("pts_ok") & c("cuts_ok"))
    x = x.withColumn("technical_status", F.when(failed, "FAIL").when(F.size("warnings") > 0, "WARN").otherwise("PASS"))
    scores = {k: c(k) for k in scoring.WEIGHTS} | {"goal": c("goal_net")}
    guess = scoring.opinion(*[c(k) for k in ("player", "ball", "occlusion", "pitch", "graphics", "camera")])
    factor = F.greatest(c("seconds"), F.lit(0.001)) / F.greatest(c("source_duration"), F.lit(0.001))
    x = x.withColumns({"opinion": F.coalesce("survey", guess), "quality": scoring.quality(scores, c("survey")), "realtime_factor": F.when(c("seconds").isNotNull(), factor)})
    score, status = scoring.performance(c("realtime_factor"))
    x = x.withColumns({"quality_status": scoring.quality_status(c("quality")), "performance": score, "performance_status": status})
    x = x.withColumns({f"added_{k}": F.greatest(F.lit(0.0), F.coalesce(c(f"output_{k}"), F.lit(0.0)) - c(f"source_{k}")) for k in NUMBERS["artifact"]})
    x = x.withColumns({f"severity_{k}": scoring.severity(c(f"added_{k}")) for k in NUMBERS["artifact"]})
    return x.withColumn("recommendation", scoring.recommendation(c("technical_status") != "FAIL", c("quality"), c("performance_status")))
