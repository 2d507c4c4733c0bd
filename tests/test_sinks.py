"""Image and clip sinks, the command line, streams side by side, and long clips cut in stretches."""
import datetime
import json
import struct
import zlib

import duckdb
import numpy as np
import pytest

from cadenza.__main__ import main
from cadenza.plans import catalog
from cadenza.plans import evaluate as E
from cadenza.sources import images
from tests.test_evaluate import disc, frames, moving, pitch


def unpacked(data: bytes):
    """A PNG without line filters, read back."""
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    at, parts = 8, {}
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        assert struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + body)
        parts[kind], at = body, at + 12 + n
    w, h, depth, colour = struct.unpack(">IIBB", parts[b"IHDR"][:10])
    c = {0: 1, 2: 3}[colour]
    lines = np.frombuffer(zlib.decompress(parts[b"IDAT"]), np.uint8).reshape(h, 1 + w * c)
    assert depth == 8 and not lines[:, 0].any()
    return lines[:, 1:].reshape(h, w, c)


def test_images(spark, tmp_path):
    rng = np.random.default_rng(5)
    f = rng.integers(0, 256, (7, 5, 3)).astype(np.uint8)
    images.write_images(frames(spark, {"a/b": [f, f[:, :, :1].copy()], "..": [f]}), str(tmp_path))
    files = {str(p.relative_to(tmp_path)): unpacked(p.read_bytes()) for p in tmp_path.rglob("*") if p.is_file()}
    assert set(files) == {"clip=a%2Fb/00000000.png", "clip=a%2Fb/00000001.png", "clip=../00000000.png"}
    assert (files["clip=a%2Fb/00000000.png"] == f).all() and (files["clip=a%2Fb/00000001.png"] == f[:, :, :1]).all()


def test_pairs_of_frames(spark):
    black, gray, wide = np.zeros((4, 6, 3), np.uint8), np.full((4, 6, 3), 40, np.uint8), np.zeros((4, 9, 3), np.uint8)
    a, b = frames(spark, {"x": [black, black, black]}), frames(spark, {"x": [black, gray, wide]})
    got = {r.frame_idx: np.frombuffer(r.data, np.uint8).reshape(r.h, r.w, r.c) for r in images.heat_maps(a, b).collect()}
    assert set(got) == {0, 1} and got[0][0, 0].tolist() == [0, 0, 127] and (got[1] == images.jet(np.full((4, 6), 120 / 255))).all()
    both = {r.frame_idx: (r.h, r.w, r.c) for r in images.side_by_side(a, b).collect()}
    assert both == {0: (4, 12, 3), 1: (4, 12, 3), 2: (4, 15, 3)}
    assert [r.pts for r in images.slow_motion(a, 50).orderBy("frame_idx").collect()] == pytest.approx([0, 0.08, 0.16])
    assert images.heat_maps(a.limit(0), b).count() == 0


def test_command_line(spark, tmp_path):
    out = moving(9)
    for name, fs in (("s", out[::2]), ("o", out)):
        frames(spark, {"a": fs}).write.parquet(f"{tmp_path}/{name}")
        (tmp_path / f"{name}-probe").mkdir()
        rate = 25 if name == "s" else 50
        video = {"codec_type": "video", "r_frame_rate": f"{rate}/1", "avg_frame_rate": f"{rate}/1", "nb_frames": str(len(fs)), "duration": str(len(fs) / rate), "width": 400, "height": 300}
        (tmp_path / f"{name}-probe" / "a.json").write_text(json.dumps({"streams": [video], "format": {}}))
    p = lambda x: f"{tmp_path}/{x}"
    assert main(["evaluate", "--source", p("s"), "--output", p("o"), "--source-probe", p("s-probe"), "--output-probe", p("o-probe"), "--report", p("report")], spark) == 0
    row = spark.read.json(p("report/json")).first()
    assert (row.clip_id, row.technical_status, row.ball) == ("a", "PASS", 5.0)
    assert main(["evaluate", "--source", p("s"), "--output", p("o"), "--source-probe", p("s-probe"), "--output-probe", p("s-probe"), "--report", p("report2")], spark) == 1
    assert main(["probe", "--input", p("o-probe"), "--report", p("meta")], spark) == 0 and spark.read.json(p("meta")).first().nb_frames == 9
    spark.createDataFrame([("a", k, [float(v)]) for k, v in enumerate((0, 90, 0))], "clip_id string, frame_idx long, px array<double>").write.parquet(p("px"))
    assert main(["deflicker", "--input", p("px"), "--output", p("held")], spark) == 0
    assert [r.px for r in spark.read.parquet(p("held")).orderBy("frame_idx").collect()] == [[0.0], [10.0], [0.0]]
    assert main(["double", "--input", p("px"), "--output", p("twice")], spark) == 0
    assert [r.px for r in spark.read.parquet(p("twice")).orderBy("frame_idx").collect()] == [[0.0], [45.0], [90.0], [45.0], [0.0]]
    with pytest.raises(SystemExit):
        main(["deflicker", "--input", p("px")], spark)


def test_clips_without_source(spark):
    x = E.football(frames(spark, {"a": moving(7), "b": [disc(pitch(), 60, 60)]}))
    r = {v.clip_id: v for v in x.collect()}
    assert r["a"].ball_active == 3 and r["a"].ball == 5 and r["b"].ball_active == 0 and r["b"].graphics == 5
    assert E.football(frames(spark, {})).count() == 0


def test_long_clips(spark, tmp_path):
    """Runs, gaps and carried values over clips of several stretches, against the plain form; a clip and a value are null."""
    rng, t0 = np.random.default_rng(9), datetime.datetime(2024, 1, 1)
    rows = []
    for clip, n in (("long", 9000), (None, 4100), ("short", 3)):
        x, t = 0.0, t0
        for k in range(n):
            x += float(rng.choice([0.0, 0.0, 0.0, 5.0])) if k < 3000 else 0.0  # the last run goes over stretches
            t += datetime.timedelta(milliseconds=int(rng.choice([0, 40, 40, 120])))
            rows.append((len(rows), clip, len(rows) % 7, t, None if k % 1000 == 25 else x))
    spark.createDataFrame(rows, "event_id long, event_type string, user_id long, ts timestamp_ntz, value double").write.parquet(f"{tmp_path}/events.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    for name in ("duplicate_runs", "roi_carry_forward", "pts_gaps"):
        df = catalog.QUERIES[name](spark, str(tmp_path))
        want = duck.execute(catalog.ORACLES[name])
        cols = [c[0] for c in want.description]
        assert sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(str, want.fetchall())), name
