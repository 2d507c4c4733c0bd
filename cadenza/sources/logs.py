"""Processing logs and reports of clips: which file tells how long a clip took."""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.functions.scalars import time_in_seconds
from cadenza.session import table

#: Endings of the files that belong to a clip, the first found wins; {0} is the tool that wrote the log.
ENDINGS = ("_report.json", "_report.txt", ".log", "_{0}.log", ".json", ".txt")
KEYS = ("processing_time_sec", "total_processing_time_sec", "processing_time")


def stem(path):
    """Name of a file without folders and last ending."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def ending(path, tool="job"):
    """(stem, priority) of a log file by its ending; the longest ending counts, null priority for other files."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    base, rank = F.lit(None).cast("string"), F.lit(None).cast("int")
    for k, e in sorted(enumerate(x.format(tool) for x in ENDINGS), key=lambda x: len(x[1])):
        base = F.when(name.endswith(e), F.substring(name, F.lit(1), F.length(name) - len(e))).otherwise(base)
        rank = F.when(name.endswith(e), k).otherwise(rank)
    return base, rank


def log_folder(base, source, output, model):
    """<base>/<clip>_<model>; the output names the clip where the source has no telling name. A base that ends so stays."""
    a, b = stem(source), stem(output)
    clip = F.when(F.lower(a).isin("input", "in", "video") & ~F.lower(b).isin("output", "out"), b).otherwise(a)
    suffix = F.concat(F.lit("_"), F.replace(F.lower(model), F.lit("-"), F.lit("_")))
    folder = F.when(F.endswith(F.lower(clip), suffix), clip).otherwise(F.concat(clip, suffix))
    trimmed = F.regexp_replace(base, "/+$", "")
    return F.when(F.regexp_extract(trimmed, r"([^/]*)$", 1) == folder, base).otherwise(F.concat_ws("/", trimmed, folder))


#: A time in a text: a name of it, a separator, and a clock or a number; or that something ended in so many seconds.
NAME = "(?:total[_ ]*)?proc(?:essing)?[_ ]*time(?:_sec)?"
SIGN = r"""["']?\s*[:=]\s*["']?"""
CLOCK, NUMBER = r"\d+(?::\d+)+(?:\.\d+)?", r"\d+(?:\.\d+)?|\.\d+"
FORMS = (f"{NAME}{SIGN}({CLOCK})", f"{NAME}{SIGN}({NUMBER})(?![\\d:])", rf"(?:completed|finished)(?:\s+processing)?\s+in\s+({NUMBER})\s*s")


def seconds_in(text):
    """Processing time in free text or JSON: one of KEYS, else the first clock, number or ending above zero; null if there is none."""
    said = [F.get_json_object(text, f"$.{k}") for k in KEYS] + [F.regexp_extract(text, f"(?i){form}", 1) for form in FORMS]
    times = [F.when(x.contains(":"), time_in_seconds(x)).otherwise(x.try_cast("double")) for x in said]
    return F.coalesce(*[F.when(x > 0, x) for x in times])


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of every file below a folder."""
    return spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def match_logs(clips: DataFrame, logs: DataFrame, tool: str = "job") -> DataFrame:
    """clips(clip_id, output, source), logs(path, text) -> (clip_id, path, seconds): of the files that have a time, the first by ending.

    Files of the output's stem come before those of the source's; equal endings go by path. Logs may also end in _TOOL.log.
    """
    base, rank = ending(F.col("path"), tool)
    f = logs.withColumn("seconds", seconds_in(F.col("text"))).filter("seconds is not null").select("path", "seconds", base.alias("stem"), rank.alias("rank")).filter("stem is not null")
    want = clips.select("clip_id", F.explode(F.array(F.struct(stem(F.col("output")).alias("stem"), F.lit(0).alias("side")), F.struct(stem(F.col("source")).alias("stem"), F.lit(1).alias("side")))).alias("w"))
    x = want.select("clip_id", "w.stem", "w.side").join(f, "stem")
    first = F.row_number().over(W.partitionBy("clip_id").orderBy("side", "rank", "path"))
    return x.withColumn("n", first).filter("n = 1").select("clip_id", "path", "seconds")


def log_match(spark, sf_dir):
    """Orders as clips, documents as their logs."""
    d = table(spark, sf_dir, "documents")
    kind = F.element_at(F.array(*map(F.lit, ("_report.txt", ".log", "_job.log", ".bak"))), (F.col("doc_id") % 4 + 1).cast("int"))
    said = F.when(F.col("doc_id") % 5 == 0, F.lit("no time")).otherwise(F.concat(F.lit("Processing time: "), F.col("n_chars").cast("string")))
    files = d.select(F.concat(F.lit("/logs/clip_"), F.expr("doc_id div 2"), kind).alias("path"), said.alias("text"))
    clips = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("clip_id"), F.concat(F.lit("/out/clip_"), F.expr("o_orderkey div 3"), F.lit(".mp4")).alias("output"), F.concat(F.lit("clip_"), F.col("o_orderkey"), F.lit(".mov")).alias("source"))
    return match_logs(clips, files)


QUERIES = {"log_match": log_match}
ORACLES = {
    "log_match": """WITH f AS (SELECT doc_id // 2 AS stem, CAST(n_chars AS DOUBLE) AS seconds, CASE doc_id % 4 WHEN 0 THEN '_report.txt' WHEN 1 THEN '.log' WHEN 2 THEN '_job.log' END AS e, doc_id % 4 AS r FROM documents
  WHERE doc_id % 5 <> 0 AND doc_id % 4 < 3 AND n_chars > 0),
c AS (SELECT o_orderkey AS clip_id, o_orderkey // 3 AS stem, 0 AS side FROM orders UNION ALL SELECT o_orderkey, o_orderkey, 1 FROM orders),
j AS (SELECT clip_id, '/logs/clip_' || stem || e AS path, seconds, row_number() OVER (PARTITION BY clip_id ORDER BY side, r) AS n FROM c JOIN f USING (stem))
SELECT clip_id, path, seconds FROM j WHERE n = 1""",
}
