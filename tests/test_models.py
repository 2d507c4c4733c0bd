"""The life cycle of a model, routes of pairs, throughput, ground truth and the commands around them."""
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.__main__ import main
from cadenza.operators import models
from cadenza.plans import evaluate as E
from cadenza.plans.performance import Performance
from cadenza.sources.config import JobConfig


def frames(spark, clips):
    rows = [(c, i, *f.shape, bytearray(f.tobytes())) for c, fs in clips.items() for i, f in enumerate(fs)]
    return spark.createDataFrame(rows, models.FRAME)


def flat(*values, shape=(8, 8, 3)):
    return [np.full(shape, v, np.uint8) for v in values]


def pixels(x):
    return {(r.clip_id, r.frame_idx): np.frombuffer(r.data, np.uint8).reshape(r.h, r.w, r.c) for r in x.collect()}


class Toy(models.Interpolator):
    """Writes down what is done to it."""

    batch_size = 5
    folder = ""

    def note(self, what):
        with open(os.path.join(self.folder, f"{os.getpid()}-{id(self)}"), "a") as f:
            f.write(what + "\n")

    def load(self):
        self.note("load")

    def interpolate_batch(self, a, b):
        self.note(str(len(a)))
        if (a == 66).any():
            raise RuntimeError("no 66")
        return ((a.astype(int) + b) // 2).astype(np.uint8)

    def unload(self):
        self.note("unload")


def toy(folder):
    made = type("Own", (Toy,), {"folder": str(folder)})
    models.register("toy")(made)
    return [lines for f in folder.iterdir() if (lines := f.read_text().split())] if folder.exists() else []


def test_a_model_is_loaded_once_a_task_and_sees_its_batches(spark, tmp_path):
    folder = tmp_path / "notes"
    folder.mkdir()
    toy(folder)
    d = frames(spark, {c: flat(*range(0, 40)) for c in "ab"}).repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # batches of a model run on over Arrow's
    try:
        got = pixels(models.double_frames(d, JobConfig(model="toy", scene_threshold=2, transition_threshold=2)))  # every pair goes to the model
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == 2 * 79 and all((got[c, k] == k // 2).all() for c, k in got)
    lives = toy(folder)
    for life in lives:
        assert life[0] == "load" and life[-1] == "unload" and life.count("load") == life.count("unload") == 1
        assert all(n == "5" for n in life[1:-2]) and 1 <= int(life[-2]) <= 5
    assert sum(int(n) for life in lives for n in life[1:-1]) == 78


def test_a_model_is_unloaded_when_its_task_fails(spark, tmp_path):
    folder = tmp_path / "notes"
    folder.mkdir()
    toy(folder)
    with pytest.raises(Exception, match="no 66"):
        models.double_frames(frames(spark, {"a": flat(66, 66)}), JobConfig(model="toy")).collect()
    assert all(life[-1] == "unload" for life in toy(folder)) and toy(folder)


def test_routes(spark):
    x = {"cut": flat(0, 255), "mix": flat(100, 120), "same": flat(9, 9), None: flat(1, 2), "shape": flat(5) + flat(7, shape=(4, 8, 3))}
    got = pixels(models.double_frames(frames(spark, x), JobConfig(scene_threshold=0.5)))
    assert (got["cut", 1] == 0).all() and (got["mix", 1] == 110).all() and (got[None, 1] == 2).all() and (got["shape", 1] == 5).all()
    assert {models.route(*x[k], JobConfig(cadence_filter=True)) for k in ("same",)} == {"repeat"}
    assert models.route(*x["cut"], JobConfig()) == "cut" and models.route(*x["mix"], JobConfig(scene_threshold=0.5)) == "blend" and models.route(*x["same"], JobConfig()) == "model"
    ask = models.task_profile(2, 1).taskResources
    assert (ask["cpus"].amount, ask["gpu"].amount) == (2, 1)


def test_throughput_is_observed(spark):
    with Performance() as p:
        p.watch(models.double_frames(frames(spark, {"a": flat(*range(11))}))).write.format("noop").mode("overwrite").save()
    r = p.report(spark).first()
    assert (r.frames, r.generated, r.bytes) == (21, 10, 21 * 192) and r.seconds > 0
    assert r.frames_per_second == pytest.approx(21 / r.seconds) and r.realtime_factor == pytest.approx(r.seconds / (21 / 50)) and r.status in ("PASS", "WARN", "FAIL")


def test_ground_truth(spark):
    rng = np.random.default_rng(1)
    true = [rng.integers(0, 255, (128, 128, 3), np.uint8) for _ in range(6)]
    made = [f if k != 3 else (f // 2) for k, f in enumerate(true)]
    r = E.ground_truth(frames(spark, {"a": true, None: true}), frames(spark, {"a": made, None: true[:2]})).collect()
    a, n = (next(x for x in r if x.clip_id == k) for k in ("a", None))
    d = np.abs(true[3].astype(float) - made[3])
    assert a.n == 3 and a.mae == pytest.approx(d.mean() / 3) and a.mse == pytest.approx((d * d).mean() / 3) and a.most == d.max()
    assert a.psnr == pytest.approx((200 + 20 * np.log10(255 / np.sqrt((d * d).mean()))) / 3) and a.ssim < 1
    assert (n.n, n.psnr) == (1, 100.0) and n.ssim == pytest.approx(1) and n.ms_ssim == pytest.approx(1)
    assert E.ground_truth(frames(spark, {"a": true}), frames(spark, {"a": made}), max_frames=1).first().n == 1


def test_pts_over_stretches(spark):
    rng = np.random.default_rng(3)
    t = np.cumsum(rng.choice([0.0, 0.04, 0.04, 0.5], 4000)).round(3)
    rows = [("a", float(v)) for v in rng.permutation(t)] + [(None, 0.0), (None, 500.0), ("b", None), ("c", 1.0)]
    got = {r.clip_id: (r.pts_duplicates, r.pts_gaps, r.pts_ok) for r in E.pts_checks(spark.createDataFrame(rows, "clip_id string, pts_time double")).collect()}
    gaps = np.diff(np.sort(t))
    assert got == {"a": (int((gaps == 0).sum()), int((gaps > 0.08).sum()), False), None: (0, 1, False), "c": (0, 0, True)}


def test_pitch_sequence(spark):
    line = lambda *p: dict(zip(("x1", "y1", "x2", "y2"), p))
    odd = [line(0, 0, 100, 0), line(0, 0, 0, 100), line(0, 0, 70, 60)]
    rows = [("a", "o", i, [odd[0]] if i != 4 else odd + odd[:1]) for i in range(40)] + [("a", "s", 0, odd), ("b", "o", 0, None)]
    m = spark.createDataFrame(rows, "clip_id string, role string, frame_idx long, lines array<struct<x1:long,y1:long,x2:long,y2:long>>")
    r = {x.clip_id: x for x in E.pitch_sequence(m).collect()}
    assert (r["a"].frames, r["a"].lines, r["a"].wobbles, r["a"].drops) == (40, 43, 1, 2)
    assert r["a"].pitch_sequence == pytest.approx(5 - 1 / 40 / 0.10 * 2.5 - min(1.5, 2 / 39 / 0.05 * 1.5)) and r["b"].pitch_sequence == 5


def test_commands(spark, tmp_path):
    p = lambda x: f"{tmp_path}/{x}"
    source = flat(1, 2, 3, 4, 5, shape=(64, 64, 3))
    frames(spark, {"a": source}).write.parquet(p("s"))
    (tmp_path / "job.yaml").write_text("model: blend\nanti_flicker: true\n")
    assert main(["double", "--input", p("s"), "--output", p("o"), "--profile", p("job.yaml")], spark) == 0
    assert spark.read.parquet(p("o")).count() == 9 and spark.read.json(p("o-performance")).first().frames == 9
    for name, rate, n in (("sp", 25, 5), ("op", 50, 9)):
        os.makedirs(p(name))
        video = {"codec_type": "video", "r_frame_rate": f"{rate}/1", "avg_frame_rate": f"{rate}/1", "nb_frames": str(n), "duration": str(n / rate), "width": 64, "height": 64}
        (tmp_path / name / "a.json").write_text(json.dumps({"streams": [video], "format": {}}))
    assert main(["benchmark", "--source", p("s"), "--models", f"one={p('o')},two={p('o')}", "--source-probe", p("sp"), "--output-probe", p("op"), "--report", p("bench")], spark) == 0
    x = spark.read.option("header", True).csv(p("bench/comparison"))
    assert set(x.columns) == {"clip_id", "metric", "one", "two"} and x.count() == 12
    assert x.filter("metric = 'technical_status'").first().one in ("PASS", "WARN")
    assert main(["benchmark", "--source", p("s"), "--models", "none", "--source-probe", p("sp"), "--output-probe", p("op"), "--report", p("bench2")], spark) == 1
    assert main(["ground-truth", "--truth", p("o"), "--output", p("o"), "--report", p("gt")], spark) == 0
    assert spark.read.json(p("gt")).first().psnr == 100
    os.makedirs(p("look"))
    assert main(["inspect", "--source", p("s"), "--output", p("o"), "--report", p("look"), "--frames", "2"], spark) == 0
    assert sorted(os.listdir(p("look/generated/clip=a"))) == ["00000001.png", "00000003.png"] and len(os.listdir(p("look/differences/clip=a"))) == 2
    assert spark.read.json(p("look/slow-4")).agg(F.max("pts")).first()[0] == pytest.approx(3 / 50 * 4)


def test_validation_and_unique_values(spark):
    from cadenza.functions.scalars import ordered_unique

    kind = "clip_id string, nominal_fps double, avg_fps double, nb_frames long, audio array<int>"
    meta = spark.createDataFrame([("good", 50.4, 50.0, 104, [1]), ("bad", 49.0, 50.0, 90, None), (None, 0.0, 50.0, 100, []), ("lost", None, None, None, None)], kind)
    want = spark.createDataFrame([(c, 100, c == "bad") for c in ("good", "bad", None, "lost")], "clip_id string, frames long, sound boolean")
    got = {r.clip_id: (r.valid, r["errors"]) for r in E.validate(meta, want).collect()}
    assert got == {"good": (True, []), "bad": (False, ["rate", "audio", "frames"]), None: (True, []), "lost": (False, ["rate", "frames"])}
    r = spark.createDataFrame([(["b", None, "a", "", "b"],)], "v array<string>").select(ordered_unique(F.col("v")).alias("v")).first()
    assert r.v == ["b", "a"]
