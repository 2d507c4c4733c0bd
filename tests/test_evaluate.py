"""Detectors on drawn frames, and whole evaluations of small clips."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import detect
from cadenza.plans import evaluate as E

H, WIDE = 300, 400


def pitch(h=H, w=WIDE):
    f = np.zeros((h, w, 3), np.uint8)
    f[...] = (34, 139, 34)
    return f


def disc(f, cx, cy, r=8):
    y, x = np.mgrid[: f.shape[0], : f.shape[1]]
    f[(y - cy) ** 2 + (x - cx) ** 2 <= r * r] = 255
    return f


def frames(spark, clips, start=0):
    rows = [(c, i + start, f.shape[0], f.shape[1], f.shape[2], bytearray(f.tobytes())) for c, fs in clips.items() for i, f in enumerate(fs)]
    return spark.createDataFrame(rows, "clip_id string, frame_idx long, h int, w int, c int, data binary")


def meta(spark, clips, fps, **more):
    rows = [(c, float(fps), float(fps), len(fs) / fps, len(fs), more.get("audio", [])) for c, fs in clips.items()]
    return spark.createDataFrame(rows, "clip_id string, nominal_fps double, avg_fps double, duration double, nb_frames long, audio array<struct<duration:double,channels:int,sample_rate:int>>")


def test_labels_and_areas():
    rng = np.random.default_rng(3)
    for diagonal in (True, False):
        m = rng.random((30, 40)) < 0.45
        lab, n = detect.label(m, diagonal)
        seen, k = np.zeros(m.shape, int), 0
        for i, j in zip(*np.nonzero(m)):
            if not seen[i, j]:
                k += 1
                todo = [(i, j)]
                seen[i, j] = k
                while todo:
                    a, b = todo.pop()
                    for da, db in [(p, q) for p in (-1, 0, 1) for q in (-1, 0, 1) if diagonal or p * q == 0]:
                        z = a + da, b + db
                        if 0 <= z[0] < 30 and 0 <= z[1] < 40 and m[z] and not seen[z]:
                            seen[z] = k
                            todo.append(z)
        assert k == n and (lab == seen).all()
    assert (detect.dilate(m, 3, 5) == np.array([[m[max(0, i - 1) : i + 2, max(0, j - 2) : j + 3].any() for j in range(40)] for i in range(30)])).all()
    square = np.zeros((9, 9), bool)
    square[2:7, 3:6] = True
    assert len(detect.outline(square)) == 12 and detect.hull_area(detect.outline(square)) == 8 and detect.corners(detect.outline(square), 0.5) == 4


def test_players_balls_and_goal():
    f = disc(pitch(), 100, 100)
    f[80:140, 200:225] = (200, 30, 30)
    assert [(p["x"], p["y"], p["w"], p["h"]) for p in detect.players(f)] == [(200, 80, 25, 60)] and detect.players(f)[0]["solidity"] > 0.95
    assert [(round(b["cx"]), round(b["cy"]), round(b["r"])) for b in detect.balls(f, 0.5)] == [(100, 100, 8)]
    assert detect.balls(disc(f.copy(), 212, 100), 0.5) == detect.balls(f, 0.5)  # on the player
    assert detect.balls(f, 0.5, lines=[{"x1": 20, "y1": 100, "x2": 180, "y2": 100}]) == []
    assert detect.goal(pitch(400, 600)) is None
    g = pitch(400, 600)
    g[60:150, 100:106] = g[50:56, 110:400] = 255
    assert detect.goal(g) == {"x": 60, "y": 30, "w": 420, "h": 160}
    two, seen = pitch(), {"x": 0, "y": 0, "w": 40, "h": 40}
    assert detect.occlusions(detect.gray(two), [seen, {**seen, "x": 20}, {**seen, "x": 100}]) == (1, 0)


def test_lines_and_pitch():
    straight, wavy = pitch(400, 600), pitch(400, 600)
    straight[200:203, 50:550] = 255
    for x in range(50, 550):
        y = int(200 + 12 * np.sin(x / 25))
        wavy[y : y + 3, x] = 255
    disc(straight, 300, 320, 4)
    assert max(abs(s["x2"] - s["x1"]) for s in detect.segments(detect.line_mask(straight))) > 480
    clean, bent = detect.pitch_triplet(straight, straight, straight, 0.0), detect.pitch_triplet(straight, wavy, straight, 0.0)
    assert clean["residual"] < 0.005 and clean["warps"] == 0 and (bent["warps"] >= 1 or bent["residual"] > 0.01)
    assert detect.pitch_triplet(np.zeros((90, 90, 3), np.uint8), wavy, straight, 0.0) is None and detect.pitch_triplet(straight, wavy, straight, 0.5) is None


def flags(spark, a, x, b, people=()):
    ball = "array<struct<cx:double,cy:double,r:double,circ:double>>"
    row = (1, *[[(float(cx), float(cy), 8.0, float(c)) for cx, cy, c in z] for z in (a, x, b)], [tuple(p) for p in people])
    d = spark.createDataFrame([row], f"i int, balls_a {ball}, balls_x {ball}, balls_b {ball}, people_x array<struct<x:long,y:long,w:long,h:long>>")
    r = E.ball_triplets(d).first()
    return {k for k in ("active", "matched", "occluded", "dissolved", "wobble", "deformed", "duplicate") if r[k]}


@pytest.mark.parametrize("a,x,b,people,want", [
    ([(100, 100, 0.9)], [(110, 100, 0.9)], [(120, 100, 0.9)], (), {"active", "matched"}),
    ([(100, 100, 0.9)], [], [(120, 100, 0.9)], (), {"active", "dissolved"}),
    ([(100, 100, 0.9)], [(120, 118, 0.9)], [(140, 100, 0.9)], (), {"active", "matched", "wobble"}),
    ([], [(120, 118, 0.9)], [], (), set()),
    ([(100, 100, 0.9)], [(200, 100, 0.9)], [(300, 100, 0.9)], (), set()),
    ([(100, 100, 0.9)], [(130, 100, 0.9), (112, 100, 0.9)], [(160, 100, 0.9)], (), {"active", "matched", "duplicate"}),
    ([(100, 100, 0.9)], [(130, 100, 0.9), (130, 150, 0.9)], [(160, 100, 0.9)], (), {"active", "matched"}),
    ([(100, 100, 0.9)], [], [(140, 100, 0.9)], [(105, 70, 30, 60)], {"active", "occluded"}),
    ([(100, 100, 0.7)], [(110, 100, 0.5)], [(120, 100, 0.5)], (), {"active", "matched", "deformed"}),
    ([(10, 10, 0.6), (100, 100, 0.9), (50, 50, 0.9)], [(110, 100, 0.9)], [(120, 100, 0.9)], (), {"active", "matched"}),
])
def test_ball_triplets(spark, a, x, b, people, want):
    assert flags(spark, a, x, b, people) == want


def moving(n, step=10, lost=()):
    return [pitch() if i in lost else disc(pitch(), 60 + step * i, 150) for i in range(n)]


def test_evaluate_clips(spark):
    """A clean clip, one whose generated frames lose the ball, and one with a blend at a cut."""
    good = moving(21)
    lost = moving(21, lost=range(1, 21, 2))
    black, white = np.zeros((H, WIDE, 3), np.uint8), np.full((H, WIDE, 3), 255, np.uint8)
    cut = [black, np.full_like(black, 127), white, white, white]
    out = {"good": good, "lost": lost, "cut": cut}
    src = {"good": good[::2], "lost": lost[::2], "cut": [black, white, white]}
    timing = spark.createDataFrame([("good", 0.4), ("lost", 9.0)], "clip_id string, seconds double")
    survey = spark.createDataFrame([("lost", 2.0)], "clip_id string, score double")
    pts = spark.createDataFrame([("good", i / 50) for i in range(21)] + [("cut", 0.0), ("cut", 0.0), ("cut", 0.3)], "clip_id string, pts_time double")
    x = E.evaluate(frames(spark, src), frames(spark, out), meta(spark, src, 25), meta(spark, out, 50), pts, survey, timing, E.Config())
    r = {v.clip_id: v for v in x.collect()}
    assert set(r) == set(out)
    g, ball, c = r["good"], r["lost"], r["cut"]
    assert (g.n_source, g.n_output, g.psnr, g.mae, g.cuts, g.ball_active, g.ball_matched) == (11, 21, 100, 0, 0, 10, 10)
    assert g.technical_status == "PASS" and g.warnings == [] and g.ball == 5 and g.realtime_factor == pytest.approx(0.4 / 0.44) and g.performance == 10
    assert g.recommendation == "PRODUCTION CANDIDATE" and g.pitch_share > 0.9 and g.graphics == g.goal_net == 5
    assert (ball.ball_dissolved, ball.ball_matched, ball.ball) == (10, 0, 2.5) and ball.performance_status == "FAIL" and ball.opinion == 2
    assert (c.cuts, c.hybrids, c.cuts_ok, c.technical_status, c.pts_ok) == (1, 1, False, "FAIL", False) and c.performance is None
    assert c.recommendation.startswith("REJECTED (Technical") and "blends of two scenes at cuts" in c.warnings


def test_stretches_do_not_matter(spark):
    """Measures are the same whatever the length of a stretch; limits keep whole triplets."""
    out = {"a": moving(13, lost=(3,))}
    src = {"a": out["a"][::2]}
    cols = ["role", "frame_idx", "dx", "d1", "d2", "residual", "warp", "psnr", "cut", F.size("balls_a").alias("n"), "marking"]
    get = lambda c=E.Config(), k=16: sorted(map(str, E.measure(frames(spark, src), frames(spark, out), c, k).select(*cols).collect()))
    assert get() == get(k=4) and len(get()) == 20
    assert len(get(E.Config(max_frames=3))) == 9
    thin = E.measure(frames(spark, src), frames(spark, out), E.Config(sample_stride=3))
    assert sorted(r.frame_idx for r in thin.filter("warp is not null").collect()) == [2, 8]


def test_static_corner_and_goal(spark):
    """A fixed score board that flickers costs graphics points, a net that flutters in odd frames goal points."""
    rng = np.random.default_rng(2)
    board = rng.integers(0, 2, (20, 70)).repeat(2, 0).repeat(1, 1)[:40] * 255
    out = []
    for i in range(81):
        f = pitch(400, 600)
        f[10:50, 20:90] = np.where(board[..., None] > 0, 255 - 60 * (i % 2), 0)
        f[110:200, 200:206] = f[100:106, 210:500] = 255
        if i % 2 == 0:
            f[130:180:4, 230:480] = 230
        out.append(f)
    m = E.stored(E.measure(frames(spark, {"a": out[::2]}), frames(spark, {"a": out})))
    g = E.graphics(m, group=3).first()
    assert g.jitter > 3 and g.graphics < 5
    n = E.goal_net(m, frames(spark, {"a": out})).first()
    assert n.net_frames == 81 and n.even_net > 1.2 * n.odd_net and n.goal_net == 2.5


def test_nothing_to_evaluate(spark):
    none, some = frames(spark, {}), {"a": [pitch()]}
    assert E.evaluate(none, none, meta(spark, {}, 25), meta(spark, {}, 50)).count() == 0
    x = E.evaluate(frames(spark, some), frames(spark, some), meta(spark, some, 25), meta(spark, some, 50)).collect()
    assert len(x) == 1 and x[0].n_source == 1 and x[0].vectors == 0 and x[0].camera == 5
