"""Metadata of clips from probe output (JSON) and interlace logs, as DataFrame expressions."""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.scalars import fraction

STREAM = "codec_type index width height codec_name pix_fmt color_space color_primaries color_transfer color_range field_order r_frame_rate avg_frame_rate duration nb_frames time_base bit_rate sample_rate channels channel_layout".split()
PROBE = f"struct<streams:array<struct<{','.join(f'{n}:string' for n in STREAM)}>>,format:struct<duration:string,bit_rate:string,size:string>>"


def read_probe(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of probe files."""
    return spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def packet_times(probes: DataFrame) -> DataFrame:
    """probes(path, text) of packet JSON -> (path, pts_time): a row for each packet whose time is a number, in no order.

    Packets of a file lie in order of decoding; pts_checks() orders them by time. A file that is no JSON has none.
    """
    p = probes.select("path", F.explode(F.from_json("text", "struct<packets:array<struct<pts_time:string>>>")["packets"]).alias("p"))
    return p.select("path", F.col("p.pts_time").try_cast("double").alias("pts_time")).filter("pts_time is not null")


def interlace(text):
    """struct<interlaced, field_order, tff, bff, progressive> from the last detection line of a log; progressive without one."""
    lines = F.regexp_extract_all(text, F.lit(r"Multi frame detection:([^\n]*)"), F.lit(1))
    last = F.coalesce(F.get(lines, F.size(lines) - 1), F.lit(""))
    n = {k: F.coalesce(F.regexp_extract(last, rf"\b{name}:\s*(\d+)", 1).try_cast("long"), F.lit(0)) for k, name in (("tff", "TFF"), ("bff", "BFF"), ("progressive", "Progressive"))}
    found = (n["tff"] + n["bff"] > n["progressive"]) & (n["tff"] + n["bff"] >= 10)
    order = F.when(~found, "progressive").when(n["tff"] >= n["bff"], "tff").otherwise("bff")
    return F.struct(found.alias("interlaced"), order.alias("field_order"), *[v.alias(k) for k, v in n.items()])


def video_meta(probes: DataFrame, interlace_logs: DataFrame | None = None) -> DataFrame:
    """probes(path, text), interlace_logs(path, text) -> one row per file with a video stream; see the names below.

    Values that are missing or no number take the defaults of a broadcast clip; frame counts that
    are off the duration by more than a fifth of a second (3 frames at least) are replaced. A file
    without a video stream, or without JSON, is left out.
    """
    p = probes.withColumn("p", F.from_json("text", PROBE))
    v = F.get(F.filter("p.streams", lambda s: s["codec_type"] == "video"), F.lit(0))
    p = p.withColumn("v", v).filter("v is not null")
    num = lambda c, kind, default: F.coalesce(c.try_cast(kind), F.lit(default).cast(kind))
    text = lambda c, default: F.coalesce(c, F.lit(default))
    c = F.col
    sound = F.transform(F.filter("p.streams", lambda s: s["codec_type"] == "audio"), lambda a: F.struct(
        num(a["index"], "int", 0).alias("index"), text(a["codec_name"], "aac").alias("codec_name"), num(a["sample_rate"], "int", 48000).alias("sample_rate"), num(a["channels"], "int", 2).alias("channels"),
        a["channel_layout"].alias("channel_layout"), num(a["duration"], "double", 0.0).alias("duration"), num(a["bit_rate"], "long", 0).alias("bit_rate"), num(a["nb_frames"], "long", 0).alias("nb_frames")))
    rate, average = text(c("v.r_frame_rate"), "25/1"), text(c("v.avg_frame_rate"), "25/1")
    x = p.select(
        F.col("path"), num(c("v.width"), "int", 1920).alias("width"), num(c("v.height"), "int", 1080).alias("height"), text(c("v.codec_name"), "h264").alias("codec_name"), text(c("v.pix_fmt"), "yuv420p").alias("pix_fmt"),
        "v.color_space", "v.color_primaries", "v.color_transfer", "v.color_range", rate.alias("r_frame_rate"), average.alias("avg_frame_rate"), fraction(rate).alias("nominal_fps"), c("v.avg_frame_rate").alias("own_average"),
        F.coalesce(c("v.duration").try_cast("double"), F.when(c("v.duration").isNull(), 0.0), c("p.format.duration").try_cast("double"), F.lit(0.0)).alias("duration"), num(c("v.nb_frames"), "long", 0).alias("counted"),
        text(c("v.time_base"), "1/1000").alias("time_base"), num(c("p.format.bit_rate"), "long", 0).alias("bit_rate"), c("p.format.size").try_cast("long").alias("file_size_bytes"), sound.alias("audio"), c("v.field_order").alias("tag"))
    x = x.withColumn("avg_fps", F.coalesce(fraction(c("own_average"), float("nan")), F.lit(25.0))).withColumn("avg_fps", F.nanvl("avg_fps", "nominal_fps")).drop("own_average")
    fps = F.when(c("nominal_fps") > 0, c("nominal_fps")).otherwise(c("avg_fps"))
    guess = F.rint(c("duration") * fps).cast("long")
    wrong = (c("counted") == 0) | (F.abs(c("counted") - guess) > F.greatest(F.lit(3), F.floor(fps * 0.2)))
    x = x.withColumn("nb_frames", F.when((c("duration") > 0) & (fps > 0) & wrong, guess).otherwise(c("counted"))).drop("counted")
    if interlace_logs is None:
        x = x.withColumn("i", interlace(F.lit("")))
    else:
        x = x.join(interlace_logs.select("path", interlace(c("text")).alias("i")), "path", "left").withColumn("i", F.coalesce("i", interlace(F.lit(""))))
    tagged = c("tag").isin("tt", "bb", "tb", "bt")
    x = x.withColumns({"is_interlaced": tagged | c("i.interlaced"), "field_order": F.when(c("tag").isin("tt", "tb"), "tff").when(tagged, "bff").otherwise(c("i.field_order"))})
    return x.withColumn("is_interlaced", F.coalesce("is_interlaced", c("i.interlaced"))).drop("tag", "i")


def bitrate_target(source_rate, width, height):
    """(target, most, buffer) bits a second: 1.45 times the source's within bounds that grow with the picture."""
    size = F.greatest(F.lit(0.4), width * height / (1920 * 1080))
    target = F.greatest(3.5e6 * size, F.least(12e6 * size, 1.45 * source_rate))
    return target, 1.4 * target, 2 * target
