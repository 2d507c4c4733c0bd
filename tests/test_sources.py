"""Probe output, settings, sizing, logs, byte-range frames, moments."""
import json

import pytest
from pyspark.sql import functions as F

from cadenza.functions import scalars as S
from cadenza.plans import sizing
from cadenza.sources import config, frames, logs, probe, reports


def test_probe(spark):
    video = {"codec_type": "video", "width": 1280, "height": 720, "r_frame_rate": "25/1", "avg_frame_rate": "6480/259", "duration": "25.9", "nb_frames": "648", "field_order": "tb"}
    audio = {"codec_type": "audio", "index": 1, "sample_rate": "44100", "channels": "x", "duration": "25.8"}
    rows = [("a", json.dumps({"streams": [audio, video], "format": {"bit_rate": "99", "size": "7"}})), ("b", json.dumps({"streams": [{"codec_type": "video", "nb_frames": "5", "duration": "10", "avg_frame_rate": "0/0"}]})),
            ("c", json.dumps({"streams": [audio]})), ("d", "no json"), ("e", json.dumps({"streams": [{"codec_type": "video", "duration": "N/A"}], "format": {"duration": "2.0"}})), (None, None)]
    log = "x\nMulti frame detection: TFF: 1 BFF: 0 Progressive: 9\n[idet] Multi frame detection: TFF:   3 BFF:   40 Progressive:     7 Undetermined: 1\n"
    d = spark.createDataFrame(rows, "path string, text string")
    r = {x.path: x for x in probe.video_meta(d, spark.createDataFrame([("b", log)], "path string, text string")).collect()}
    assert set(r) == {"a", "b", "e"}
    a, b, e = r["a"], r["b"], r["e"]
    assert (a.width, a.nb_frames, a.field_order, a.is_interlaced, a.bit_rate, a.file_size_bytes) == (1280, 648, "tff", True, 99, 7) and a.avg_fps == pytest.approx(6480 / 259)
    assert [(s.sample_rate, s.channels, s.codec_name, s.duration) for s in a.audio] == [(44100, 2, "aac", 25.8)]
    assert (b.width, b.nb_frames, b.avg_fps, b.field_order, b.is_interlaced) == (1920, 250, 25.0, "bff", True)
    assert (e.duration, e.nb_frames, e.is_interlaced, e.codec_name) == (2.0, 50, False, "h264")
    assert [x.is_interlaced for x in probe.video_meta(d).filter("path = 'b'").collect()] == [False]
    t = spark.range(1).select(*probe.bitrate_target(F.lit(4e6), F.lit(1920), F.lit(1080))).first()
    assert list(t) == pytest.approx([5.8e6, 8.12e6, 11.6e6])


def test_config(tmp_path):
    (tmp_path / "p.yaml").write_text("model: blend\ngpus: '0, 2'\nresolution: 1080p\nscene_threshold: 0.4\n")
    with pytest.warns(UserWarning, match="gpus, resolution"):
        c = config.from_yaml(str(tmp_path / "p.yaml"))
    assert (c.model, c.scene_threshold, c.transition_threshold) == ("blend", 0.4, 0.12)
    with pytest.raises(ValueError, match="colour"):
        config.from_dict({"colour": 1})


def test_sizing(spark):
    rows = [("open", 500, 8, 128.0, None, None), ("asked", 1000, 16, 128.0, 3, 500), ("small", 9000, 16, 1.0, None, None), ("tiny", 7, 1, 1.0, None, None)]
    jobs = spark.createDataFrame([(i, n, 1920, 1080, cpus, ram, w, k, 0.9) for i, n, cpus, ram, w, k in rows], "job_id string, total_frames long, width int, height int, cpus int, ram_gb double, workers int, chunk_size int, ratio double")
    r = {x.job_id: (x.n_workers, x.chunk_size, x.n_chunks) for x in sizing.allocate(jobs).collect()}
    assert r == {"open": (4, 125, 4), "asked": (3, 500, 2), "small": (4, 50, 180), "tiny": (1, 50, 1)}


def test_packet_times(spark):
    rows = [("/x/a.json", json.dumps({"packets": [{"pts_time": "0.04"}, {"pts_time": "0.0"}, {"pts_time": "N/A"}, {"dts_time": "1"}]})), ("/x/b.json", "no"), ("c", json.dumps({"packets": []}))]
    got = probe.packet_times(spark.createDataFrame(rows, "path string, text string")).collect()
    assert sorted(map(tuple, got)) == [("/x/a.json", 0.0), ("/x/a.json", 0.04)]


def test_logs(spark, tmp_path):
    for name, text in (("a_report.json", '{"processing_time_sec": "01:02.5"}'), ("a.log", "Processing time: 99"), ("b.log", "nothing"), ("b_job.log", "Finished processing in 7.5 s"), ("src.txt", "total_proc_time = 3"), ("d.json", '{"processing_time": 0}')):
        (tmp_path / name).write_text(text)
    clips = spark.createDataFrame([("1", "/x/a.mp4", "src.mov"), ("2", "b.mp4", "none.mov"), ("3", "c.mkv", "/y/src.mov"), ("4", "d.mp4", "d.mov")], "clip_id string, output string, source string")
    got = {r.clip_id: (r.path.rsplit("/", 1)[1], r.seconds) for r in logs.match_logs(clips, logs.read_logs(spark, str(tmp_path))).collect()}
    assert got == {"1": ("a_report.json", 62.5), "2": ("b_job.log", 7.5), "3": ("src.txt", 3.0)}
    folder = lambda *a: spark.range(1).select(logs.log_folder(*map(F.lit, a))).first()[0]
    assert [folder("log", "/v/match.mp4", "o.mp4", "AMT-G"), folder("log/", "input.mp4", "clip_rife.mp4", "rife"), folder("x/match_rife", "match.mp4", "out.mp4", "rife")] == ["log/match_amt_g", "log/clip_rife", "x/match_rife"]


def test_frames_by_byte_range(spark, tmp_path):
    data = bytes(range(240)) + b"xx"
    (tmp_path / "clip.rgb").write_bytes(data)
    (tmp_path / "empty.rgb").write_bytes(b"")
    spark.dataSource.register(frames.RawFrames)
    read = lambda **o: sorted((r.clip_id, r.frame_idx, bytes(r.data)) for r in spark.read.format("raw_frames").options(path=str(tmp_path), height=2, width=2, **o).load().collect())
    assert read(frames_per_task=3) == [("clip", i, data[12 * i : 12 * i + 12]) for i in range(20)]
    assert [i for _, i, _ in read(start=18, count=9)] == [18, 19] and read(start=50) == []
    x = spark.createDataFrame([("a", i) for i in range(9)], "clip_id string, frame_idx long")
    assert [r.frame_idx for r in frames.first_generated(x, 2).collect()] == [1, 3] and frames.first_output(x, 3).count() == 6
    parts = spark.createDataFrame([("a", k, i, 4 * k + i) for k in range(2) for i in range(5)], "clip_id string, chunk_id int, local_idx int, frame_idx int")
    assert sorted(r.frame_idx for r in frames.merge_chunks(parts).collect()) == list(range(9))


def test_moments_and_long_form(spark):
    x = spark.createDataFrame([("a", i, 1.0 + 20 * (i in (5, 7))) for i in range(100)] + [("b", 0, 1.0)], "clip_id string, frame_idx long, warp double")
    m = reports.suspicious_moments(x, top=1).collect()
    assert [(r.clip_id, r.frame_index, r.severity, r.timestamp_str) for r in m] == [("a", 5, 4, "00:00:00.100")]
    w = spark.createDataFrame([("m", 1.5)], "model string, quality double")
    assert [tuple(r) for r in reports.long_form(w, ["model"], {"quality": ("Scorecard", "0-10")}).collect()] == [("m", "Scorecard", "quality", "1.5", "0-10")]


def test_more_scalars(spark):
    r = spark.range(1).select(S.finite(F.lit(float("nan"))), S.finite(F.lit(2.0)), S.finite(F.lit(float("-inf")), 9.0), S.every(F.array(*map(F.lit, range(7))), 3, 1), S.entry(F.create_map(F.lit("a"), F.lit(1)), "b", 4), S.missing_of(F.array(F.lit("x"), F.lit("y")), F.array(F.lit("x")))).first()
    assert list(r) == [0.0, 2.0, 9.0, [1, 4], 4, ["y"]]
