"""Pages of clips: marks escaped, the most severe moments in order, clips without moments, null keys."""
import html
import re

from cadenza.sources import reports


def test_pages_of_clips(spark):
    scores = spark.createDataFrame([("a<b", 4.5, "PASS (all)", "x&y"), ("plain", 1.0, "FAIL", None), (None, None, None, "'q'"), ("nan", float("nan"), "UNKNOWN", "")], "clip_id string, quality double, status string, `a.note` string")
    moments = spark.createDataFrame([("a<b", i, (i * 7) % 5, float(i % 3), "<jump> %d" % i) for i in range(60)] + [(None, 1, 3, 1.0, "of none")], "clip_id string, frame_index long, severity int, anomaly_score double, description string")
    got = {r.clip_id: r.page for r in reports.dashboards(scores, moments, bars=("quality",), pills=("status",), top=20).collect()}
    assert set(got) == {"a<b", "plain", None, "nan"} and all(p.startswith("<!doctype html>") and p.count("<h1>") == 1 for p in got.values())
    want = sorted(range(60), key=lambda i: (-((i * 7) % 5), -(i % 3), i))[:20]
    assert [int(x) for x in re.findall("&lt;jump&gt; ([0-9]+)", got["a<b"])] == want
    assert "<h1>a&lt;b</h1>" in got["a<b"] and "x&amp;y" in got["a<b"] and 'class="pill good"' in got["a<b"] and "width:90%" in got["a<b"] and "4.50" in got["a<b"]
    assert "<p>none</p>" in got["plain"] and "bar low" in got["plain"] and 'class="pill bad"' in got["plain"]
    assert "of none" in got[None] and "&#x27;q&#x27;" in got[None] and "–" in got[None] and "–" in got["nan"]


def test_escape_equals_the_standard_one(spark):
    texts = ["", "a&b", "<i class=\"x\">'&amp;'</i>", "é😀", None]
    d = spark.createDataFrame([(t,) for t in texts], "t string").select("t", reports.escape_html(reports.F.col("t")).alias("e"))
    assert all(r.e == html.escape(r.t or "") for r in d.collect())


def test_report_writes_a_page_a_clip(spark, tmp_path):
    scores = spark.createDataFrame([(1, 3.0, "PASS"), (2, 2.0, "FAIL")], "clip_id long, quality double, status string")
    moments = spark.createDataFrame([(1, 7, 4, 3.5)], "clip_id long, frame_index long, severity int, anomaly_score double")
    reports.write_report(scores, moments, str(tmp_path), ["clip_id"])
    pages = {r.clip_id: r.value for r in spark.read.text(f"{tmp_path}/pages").collect()}
    assert set(pages) == {1, 2} and "<td>7</td>" in pages[1] and "<p>none</p>" in pages[2]


def test_empty_tables(spark):
    scores, moments = spark.createDataFrame([], "clip_id long, q double"), spark.createDataFrame([], "clip_id long, severity int")
    assert reports.dashboards(scores, moments).count() == 0
