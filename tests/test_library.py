"""Kernels, models, sources, sinks, scalars and the stream against plain versions."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.functions import scalars as S
from cadenza.operators import kernels, models
from cadenza.sources import frames, reports
from cadenza.streaming.sequence import triplets


def test_ssim_and_motion(spark):
    rng = np.random.default_rng(3)
    a = rng.uniform(0, 255, (5, 8, 8))
    assert np.allclose(kernels.ssim_arrays(a, a), 1)
    k = np.exp(-((np.arange(11) - 5) ** 2) / 4.5)
    k = np.outer(k, k) / k.sum() ** 2
    p, q = np.pad(a[0], 5, mode="reflect"), np.pad(a[1], 5, mode="reflect")
    got = []
    for y in range(8):
        for x in range(8):
            u, v = p[y : y + 11, x : x + 11], q[y : y + 11, x : x + 11]
            mu, mv = (k * u).sum(), (k * v).sum()
            su, sv, c = (k * u * u).sum() - mu**2, (k * v * v).sum() - mv**2, (k * u * v).sum() - mu * mv
            got.append((2 * mu * mv + 6.5025) * (2 * c + 58.5225) / ((mu**2 + mv**2 + 6.5025) * (su + sv + 58.5225)))
    assert np.isclose(kernels.ssim_arrays(a[:1], a[1:2])[0], np.mean(got))
    dy, dx = kernels.shift_arrays(a, np.roll(a, (2, -3), (1, 2)))
    assert np.allclose(dy, 2) and np.allclose(dx, -3)
    y, x = np.mgrid[:32, :32]
    spot = lambda cy, cx: 255 * np.exp(-((y - cy) ** 2 + (x - cx) ** 2) / 18)
    dy, dx = kernels.shift_arrays(spot(14, 15)[None], spot(15.5, 12.75)[None])
    assert abs(dy[0] - 1.5) < 0.5 and abs(dx[0] + 2.25) < 0.5  # between pixels
    rows = [(0, a[0].ravel().tolist(), np.roll(a[0], 1, 0).ravel().tolist())]
    r = spark.createDataFrame(rows, "i int, a array<double>, b array<double>").select(kernels.motion()("a", "b").alias("m"), kernels.ssim()("a", "a").alias("s")).first()
    assert np.allclose(tuple(r.m), (1, 0)) and abs(r.s - 1) < 1e-9


def test_models(spark):
    f = spark.createDataFrame([("a", 0, [0.0, 2.0]), ("a", 1, [4.0, 4.0]), ("b", 0, [1.0, 1.0])], "clip_id string, frame_idx long, px array<double>")
    got = {(r.clip_id, r.frame_idx): r.px for r in models.double_rate(f).collect()}
    assert got == {("a", 0): [0, 2], ("a", 1): [2, 3], ("a", 2): [4, 4], ("b", 0): [1, 1]}
    with pytest.raises(KeyError, match="blend"):
        models.get("nothing")


def test_raw_frames(spark, tmp_path):
    data = bytes(range(24)) + b"xx"
    (tmp_path / "clip.rgb").write_bytes(data)
    (tmp_path / "empty.rgb").write_bytes(b"")
    x = frames.read_raw(spark, str(tmp_path), 2, 2)
    assert {(r.clip_id, r.frame_idx): bytes(r.data) for r in x.collect()} == {("clip", 0): data[:12], ("clip", 1): data[12:24]}
    assert [r.frame_idx for r in frames.read_raw(spark, str(tmp_path), 2, 2, start=1, count=9).collect()] == [1]
    frames.write_frames(x, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_reports_and_state(spark, tmp_path):
    s = spark.createDataFrame([("m", 1.5, "ok")], "model string, quality double, status string")
    m = spark.createDataFrame([(i % 5, f"<{i}>") for i in range(30)], "severity int, description string")
    reports.write_report(s, m, str(tmp_path / "r"), ["model"])
    assert {(r.metric, r.value) for r in spark.read.option("header", True).csv(str(tmp_path / "r/csv")).collect()} == {("quality", "1.5"), ("status", "ok")}
    page = spark.read.option("wholetext", True).text(str(tmp_path / "r/html")).first().value
    assert page.count("<tr>") == 2 + 21 and "&lt;" in page and spark.read.json(str(tmp_path / "r/json")).count() == 1
    plan = spark.createDataFrame([("j", i) for i in range(4)], "job_id string, chunk_id int")
    for status, ids in (("failed", [0, 1]), ("completed", [1, 2])):
        done = spark.createDataFrame([("j", i, status, None, 1.0) for i in ids], "job_id string, chunk_id int, status string, output_file string, elapsed_seconds double")
        reports.record_chunks(done, str(tmp_path / "state"))
    assert sorted(r.chunk_id for r in reports.pending_chunks(plan, str(tmp_path / "state")).collect()) == [0, 3]
    (tmp_path / "s.json").write_text('{"model": "a", "player": 4}\nbad\n')
    assert [(r.model, r.player, r.ball) for r in reports.read_survey(spark, str(tmp_path / "s.json")).collect()] == [("a", 4.0, None)]


def test_scalars(spark):
    t = F.lit
    r = spark.range(1).select(
        S.format_timestamp(t(59.9996)).alias("a"), S.format_timestamp(t(3661.25)).alias("b"), S.format_duration(t(59.6)).alias("c"), S.format_duration(t(3600.2)).alias("d"),
        S.time_in_seconds(t("1:02:03.5")).alias("e"), S.time_in_seconds(t("x")).alias("f"), S.fraction(t("6480/259")).alias("g"), S.fraction(t("1/0")).alias("h"), S.fraction(t("29.97")).alias("i"),
        S.id_list(t("0, 1,x")).alias("j"), S.name_paths(t("a=x,b=y")).alias("k"), S.colour_class(t("BT2020nc")).alias("l"), S.colour_class(t(None).cast("string")).alias("m"),
        S.circular_distance(t(0.1), t(3.1), 3.2).alias("n"), S.line_distance(t(0.0), t(3.0), t(1.0), t(0.0), t(5.0), t(0.0)).alias("o"), S.clamp(t(7), 1, 5).alias("p"))
    r = r.first().asDict()
    near = {k: r.pop(k) for k in "gn"}
    assert np.allclose([near["g"], near["n"]], [6480 / 259, 0.2])
    assert list(r.values()) == ["00:01:00.000", "01:01:01.250", "01:00", "01:00:00", 3723.5, None, 25.0, 29.97, [0, 1], {"a": "x", "b": "y"}, "bt2020", "bt709", 3.0, 5]


def test_stream_state_spans_batches(spark, tmp_path):
    """Three files, one a batch: the window carries over."""
    src, schema = tmp_path / "in", "clip_id string, ts timestamp, event_id long, x double"
    q = None
    for b in range(3):
        rows = spark.createDataFrame([(c, None, b * 4 + i, float(b * 4 + i)) for c in "ab" for i in range(4)], schema)
        rows.coalesce(1).write.mode("append").parquet(str(src))
        q = triplets(spark.readStream.schema(schema).parquet(str(src))).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination(90)
    got = sorted((r.clip_id, r.event_id, r.x1, r.x2) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    n = lambda v: float(v) if v >= 0 else None
    assert got == [(c, i, n(i - 1), n(i - 2)) for c in "ab" for i in range(12)]


def test_vision_kernels():
    from cadenza.operators import vision as V

    rng = np.random.default_rng(5)
    a = rng.uniform(0, 255, (24, 24))
    assert np.allclose(V.ms_ssim_arrays(a[None], a[None], 8), sum(V.SCALES[:2]) / sum(V.SCALES))
    black, white = np.zeros((100, 100, 3)), np.full((100, 100, 3), 255)
    assert V.frame_difference(black, black) == 0 and np.isclose(V.frame_difference(black, white), 1)
    b = np.roll(a, (2, -3), (0, 1))
    f = V.flow(a, b)
    assert (f[6:18, 6:18] == (2, -3)).all()
    assert np.allclose(V.warp(b, f)[6:18, 6:18], a[6:18, 6:18])
    assert V.flow_consistency(a, a, a)[0] == 0
    assert V.clamp_envelope(black, white, black).max() == 10


def _square(at, up=0):
    """A textured square at column `at` of a flat frame."""
    f = np.full((64, 64), 90.0)
    f[20 - up : 34 - up, at : at + 14] = np.random.default_rng(2).uniform(0, 255, (14, 14))
    return f


def test_flow_consistency_tells_interpolation_from_repetition():
    from cadenza.operators import vision as V

    for step in (4, 8, 16):
        a, b = _square(20), _square(20 + step)
        assert V.flow_consistency(a, a, a)[0] == 0
        good, repeated, high = (V.flow_consistency(a, x, b)[0] for x in (_square(20 + step // 2), a, _square(20 + step // 2, 3)))
        assert good < 0.35 * min(repeated, high) and repeated > 1 and high > 1
        assert V.flow_consistency(a, b, b)[0] > 2 * good  # the frame after, shown too early
        assert V.flow_consistency(a, a, b)[3] > 0
    moved = V.warp(_square(10), -V.flow(_square(10), _square(30)) / 2.0)  # warps go the way of the motion
    centre = lambda f: (np.abs(f - 90).sum(0) * np.arange(64)).sum() / np.abs(f - 90).sum()
    assert centre(moved) > centre(_square(10)) + 2


def test_flow_residual_equals_a_plain_version(spark):
    """Every triplet of the table, with loops over pixels and steps."""
    from cadenza.operators import vision as V

    d = "/root/testdata/sf0.001"
    px = {r.vec_id: (np.array(r.embedding, float) + 1).reshape(8, 8) * 127.5 for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()}

    def plain_flow(a, b):
        edge = lambda y, x: (min(max(y, 0), 7), min(max(x, 0), 7))
        out = np.zeros((8, 8, 2))
        for y in range(8):
            for x in range(8):
                best = None
                for dy, dx in sorted(((i, j) for i in range(-4, 5) for j in range(-4, 5)), key=lambda s: (s[0] ** 2 + s[1] ** 2, s)):
                    at = [edge(y + i, x + j) for i in range(-2, 3) for j in range(-2, 3)]
                    cost = sum(abs(a[p] - b[edge(p[0] + dy, p[1] + dx)]) for p in at)
                    if best is None or cost < best - 1e-9:
                        best, out[y, x] = cost, (dy, dx)
        return out

    got = {r.frame_idx: r for r in V.QUERIES["flow_residual"](spark, d).collect()}
    assert set(got) == {i for i in px if i + 1 in px and i + 2 in px}
    for i in sorted(got)[:12]:
        a, x, b = (px[i + k] for k in range(3))
        ab, ba = plain_flow(a, b), plain_flow(b, a)
        pa, pb = V.warp(a, -ab / 2), V.warp(b, -ba / 2)
        res = np.array([[min(abs(x[p] - pa[p]), abs(x[p] - pb[p])) if np.hypot(*(ab[p] + ba[p])) > 3 else abs(x[p] - (pa[p] + pb[p]) / 2) for p in zip([y] * 8, range(8))] for y in range(8)])
        assert abs(got[i]["mean"] - res.mean()) < 1e-5 and abs(got[i].p95 - np.percentile(res, 95)) < 1e-5
        assert abs(got[i].magnitude - np.hypot(ab[..., 0], ab[..., 1]).mean()) < 1e-5


def test_deflicker(spark):
    from cadenza.operators import vision as V

    f = spark.createDataFrame([("a", i, [float(v)]) for i, v in enumerate((10, 250, 12, 14))], "clip_id string, frame_idx long, px array<double>")
    assert {r.frame_idx: r.px for r in V.deflicker(f).collect()} == {0: [10], 1: [22], 2: [12], 3: [14]}


def test_flow_of_a_stack_is_that_of_its_frames(spark):
    """One search for all frames of a batch, on every task there is."""
    from cadenza.operators import vision as V

    rng = np.random.default_rng(3)
    for shape in ((40, 8, 8), (4, 26, 31)):
        a, x, b = (rng.uniform(0, 255, shape) for _ in range(3))
        b[::2] = np.roll(a[::2], (1, -2), (1, 2))
        assert (V.flow(a, b) == [V.flow(p, q) for p, q in zip(a, b)]).all()
        assert (np.array(V.flow_consistency(a, x, b)).T == [V.flow_consistency(*z) for z in zip(a, x, b)]).all()
    parts = V.QUERIES["flow_residual"](spark, "/root/testdata/sf0.001").select("frame_idx", F.spark_partition_id().alias("p"))
    assert parts.select("p").distinct().count() >= 4
