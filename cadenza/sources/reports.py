"""Report sinks, job-state table, survey and log sources; all files go through Spark's writers."""
import html

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.scalars import time_in_seconds

STATE = "job_id string, chunk_id int, status string, output_file string, elapsed_seconds double, recorded_at timestamp"
SURVEY = "model string, player double, ball double, overall double"


#: Columns of the list of suspicious moments.
MOMENT = "timestamp_sec double, timestamp_str string, frame_index long, anomaly_type string, severity int, anomaly_score double, description string"


def long_form(wide: DataFrame, keys: list[str], about: dict | None = None) -> DataFrame:
    """One row per key and measure: metric, value (text); about {metric: (category, target)} adds these columns."""
    rest = [c for c in wide.columns if c not in keys]
    out = wide.select(*keys, *[F.col(c).cast("string").alias(c) for c in rest]).unpivot(keys, rest, "metric", "value")
    if about is None:
        return out
    known = F.create_map(*[F.lit(x) for k, v in about.items() for x in (k, v[0])]), F.create_map(*[F.lit(x) for k, v in about.items() for x in (k, v[1])])
    return out.select(*keys, known[0][F.col("metric")].alias("category"), "metric", "value", known[1][F.col("metric")].alias("target"))


def suspicious_moments(metrics: DataFrame, fps: float = 50.0, least: float = 2.5, top: int = 25) -> DataFrame:
    """metrics(clip_id, frame_idx, warp) -> the `top` frames of each clip farthest above its mean, in deviations; ties in frame order."""
    from pyspark.sql import Window as W

    from cadenza.functions.scalars import format_timestamp

    stats = metrics.groupBy("clip_id").agg(F.avg("warp").alias("mu"), F.stddev_pop("warp").alias("sd"))
    z = (F.col("warp") - F.col("mu")) / F.when(F.col("sd") < 1e-4, 1.0).otherwise(F.col("sd"))
    x = metrics.join(stats, "clip_id").withColumn("anomaly_score", F.round(z, 2)).filter(z >= least)
    rank = F.row_number().over(W.partitionBy("clip_id").orderBy(F.desc("anomaly_score"), "frame_idx"))
    at = F.col("frame_idx") / fps
    return x.withColumn("rank", rank).filter(F.col("rank") <= top).select(
        "clip_id", at.alias("timestamp_sec"), format_timestamp(at).alias("timestamp_str"), F.col("frame_idx").cast("long").alias("frame_index"), F.lit("flow_discontinuity").alias("anomaly_type"),
        F.when(z >= 4, 4).otherwise(3).alias("severity"), "anomaly_score", F.format_string("warping error %.2f above the clip's mean", F.col("anomaly_score")).alias("description"))


def render_text(rows: list) -> str:
    return "\n".join("  ".join(f"{k}: {v}" for k, v in r.asDict().items()) for r in rows)


def render_html(title: str, columns: list[str], rows: list) -> str:
    cell = lambda tag, v: f"<{tag}>{html.escape(str(v))}</{tag}>"
    head = "".join(cell("th", c) for c in columns)
    body = "".join("<tr>" + "".join(cell("td", v) for v in r) + "</tr>" for r in rows)
    return f"<!doctype html><title>{html.escape(title)}</title><table><tr>{head}</tr>{body}</table>"


STYLE = (
    "body{font:15px sans-serif;margin:2em;color:#222}table{border-collapse:collapse;margin:1em 0}td,th{border:1px solid #ccc;padding:.3em .7em;text-align:left}"
    ".bar{width:12em;background:#eee}.bar i{display:block;height:.9em;background:#4a7}.low i{background:#c54}.pill{border-radius:1em;padding:.1em .8em;background:#ddd}.good{background:#bdb}.bad{background:#ebb}"
)


def escape_html(c):
    """Column: text with the five marks of HTML escaped; null is empty."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(mark), F.lit(name))
    return c


def score_bar(score, full: float = 5.0):
    """Column: a bar as wide as the share of `full`, cut to 0 to 100 %, and the score; a dash for null."""
    share = F.least(F.lit(100.0), F.greatest(F.lit(0.0), score.cast("double") / full * 100))
    bar = F.concat(F.when(share < 60, '<div class="bar low">').otherwise('<div class="bar">'), F.lit('<i style="width:'), F.round(share).cast("int").cast("string"), F.lit('%"></i></div>'), F.format_string("%.2f", score.cast("double")))
    return F.when(score.isNull() | F.isnan(score.cast("double")), "–").otherwise(bar)


def status_pill(status):
    """Column: a coloured mark by the first word of a status."""
    first = F.upper(F.regexp_extract(F.coalesce(status, F.lit("")), r"([A-Za-z-]+)", 1))
    kind = F.when(first.isin("PASS", "EXCELLENT", "GOOD", "APPROVED", "PREFERRED"), "pill good").when(first.isin("FAIL", "POOR", "REJECTED", "UNACCEPTABLE"), "pill bad").otherwise("pill")
    return F.concat(F.lit('<span class="'), kind, F.lit('">'), escape_html(status), F.lit("</span>"))


def dashboards(scores: DataFrame, moments: DataFrame, key: str = "clip_id", bars: tuple = (), pills: tuple = (), full: float = 5.0, top: int = 20) -> DataFrame:
    """One standalone page for each row of scores -> (key, page), made where the row is.

    bars, pills: columns of scores shown as bars and as statuses; the others stand as text, in their order.
    moments(key, and the columns of MOMENT that there are): the `top` most severe of a clip, then of the
    highest anomaly score, then the earliest; a clip without moments says so. Rows of moments are ranked
    before they are gathered, so a list holds `top` at most. A null key matches a null key.
    """
    from pyspark.sql import Window as W

    name = lambda c: "`" + c.replace("`", "``") + "`"
    names = [c.split(" ")[0] for c in MOMENT.split(", ")]
    shown = [c for c in names if c in moments.columns]
    order = [F.desc_nulls_last(c) for c in ("severity", "anomaly_score") if c in shown] + [F.asc_nulls_last(c) for c in ("frame_index", "timestamp_sec", "anomaly_type", "description") if c in shown]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), escape_html(F.col(c)), F.lit("</td>")) for c in shown], F.lit("</tr>"))
    ranked = moments.select(F.col(name(key)).alias("k"), F.row_number().over(W.partitionBy(name(key)).orderBy(*order or [F.lit(1)])).alias("rank"), row.alias("row")).filter(F.col("rank") <= top)
    lists = ranked.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("rank", "row"))).alias("rows"))
    cell = lambda c: score_bar(F.col(name(c)), full) if c in bars else status_pill(F.col(name(c))) if c in pills else escape_html(F.col(name(c)))
    lines = [F.concat(F.lit(f"<tr><th>{html.escape(c)}</th><td>"), cell(c), F.lit("</td></tr>")) for c in scores.columns if c != key]
    body = scores.select(F.col(name(key)).alias("k"), F.concat(F.lit("<table>"), *lines, F.lit("</table>")).alias("body"))
    head = F.lit("<tr>" + "".join(f"<th>{c}</th>" for c in shown) + "</tr>")
    found = F.concat(F.lit("<table>"), head, F.array_join(F.transform("rows", lambda r: r["row"]), ""), F.lit("</table>"))
    title = escape_html(F.col("b.k"))
    page = F.concat(F.lit('<!doctype html><html><head><meta charset="utf-8"><title>'), title, F.lit(f"</title><style>{STYLE}</style></head><body><h1>"), title, F.lit("</h1>"), F.col("body"), F.lit("<h2>Moments</h2>"),
                    F.coalesce(found, F.lit("<p>none</p>")), F.lit("</body></html>"))
    return body.alias("b").join(lists.alias("l"), F.col("b.k").eqNullSafe(F.col("l.k")), "left").select(F.col("b.k").alias(key), page.alias("page"))


def write_report(scores: DataFrame, moments: DataFrame, path: str, keys: list[str], top: int = 20) -> None:
    """json, long csv, csv of all moments, a page and text of the scores and `top` moments, and a page of each clip (`pages`, where moments have clip_id).

    The JSON written first is what the other reports read, so scores are computed once.
    """
    spark = scores.sparkSession
    scores.write.mode("overwrite").json(f"{path}/json")
    scores = spark.read.schema(scores.schema).json(f"{path}/json")
    long_form(scores, keys).write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    listed = [F.col(n).cast(t) if n in moments.columns else F.lit(None).cast(t).alias(n) for n, t in (c.split(" ") for c in MOMENT.split(", "))]
    moments.select(*[c for c in moments.columns if c == "clip_id"], *listed).write.mode("overwrite").option("header", True).csv(f"{path}/suspicious")
    some = moments.orderBy(F.desc("severity"), *[F.col(c) for c in moments.columns if c != "severity"]).limit(top).collect()
    page = render_html("scores", scores.columns, scores.orderBy(*keys).limit(top).collect()) + render_html("moments", moments.columns, some)
    for name, text in (("html", page), ("text", render_text(some))):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(f"{path}/{name}")
    if "clip_id" in scores.columns and "clip_id" in moments.columns:
        _write_pages(scores, moments, path, top)


def _write_pages(scores: DataFrame, moments: DataFrame, path: str, top: int) -> None:
    """A page a line under its clip's folder; columns of status and numbers up to 5 as pills and bars."""
    numbers = tuple(f.name for f in scores.schema if f.dataType.typeName() in ("double", "float") and not f.name.endswith(("seconds", "factor", "psnr")))
    states = tuple(f.name for f in scores.schema if f.dataType.typeName() == "string" and f.name.endswith(("status", "recommendation", "performance")))
    dashboards(scores, moments, bars=numbers, pills=states, top=top).write.mode("overwrite").partitionBy("clip_id").option("lineSep", "\n").text(f"{path}/pages")


def record_chunks(results: DataFrame, path: str) -> None:
    results.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(path)


def pending_chunks(planned: DataFrame, path: str) -> DataFrame:
    """Chunks of planned(job_id, chunk_id) whose last record is not 'completed'; of records of one moment a completed one counts."""
    spark = planned.sparkSession
    last = spark.read.schema(STATE).parquet(path).groupBy("job_id", "chunk_id").agg(F.max(F.struct("recorded_at", (F.col("status") == "completed").alias("done"))).alias("last"))
    return planned.join(last.filter("last.done"), ["job_id", "chunk_id"], "left_anti")


def read_survey(spark: SparkSession, path: str) -> DataFrame:
    """Human scores; rows that are no JSON become nulls and are left out."""
    return spark.read.schema(SURVEY).option("mode", "PERMISSIVE").json(path).filter("model is not null")
