"""Command line: python -m cadenza COMMAND, or the same by spark-submit.

Frames are Parquet as write_frames() stores them (clip_id, frame_idx, h, w, c, data); double and
deflicker take pixel arrays (clip_id, frame_idx, px). Metadata are folders of probe JSON whose files
are named after the clips.
"""
import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cadenza.operators import models, vision
from cadenza.plans import evaluate as E
from cadenza.plans.performance import Performance
from cadenza.sources import config, frames, images, logs, probe, reports


def _meta(spark, path):
    return probe.video_meta(probe.read_probe(spark, path)).withColumn("clip_id", logs.stem(F.col("path")))


def evaluate(spark, a) -> int:
    """Writes the report; 0 if no clip failed technically, else 1."""
    settings = E.Config(max_frames=a.max_frames, sample_stride=a.sample_stride, target_fps=a.target_fps)
    source, output = spark.read.parquet(a.source), spark.read.parquet(a.output)
    measured = E.stored(E.measure(source, output, settings))
    pts = None
    if a.packets:
        pts = probe.packet_times(probe.read_probe(spark, a.packets)).select(logs.stem(F.col("path")).alias("clip_id"), "pts_time")
    scores = E.evaluate(source, output, _meta(spark, a.source_probe), _meta(spark, a.output_probe), pts, config=settings, measured=measured)
    moments = reports.suspicious_moments(measured.filter("warp is not null").select("clip_id", "frame_idx", "warp"), settings.target_fps)
    reports.write_report(scores, moments, a.report, ["clip_id"])
    return int(not spark.read.schema(scores.schema).json(f"{a.report}/json").filter("technical_status = 'FAIL'").isEmpty())


def football(spark, a) -> int:
    E.football(spark.read.parquet(a.output), E.Config(max_frames=a.max_frames)).write.mode("overwrite").json(a.report)
    return 0


def read_meta(spark, a) -> int:
    _meta(spark, a.input).write.mode("overwrite").json(a.report)
    return 0


def double(spark, a) -> int:
    """Pixel arrays are blended; frames go through the model of the profile, and what the pass took is written beside them."""
    x = spark.read.parquet(a.input)
    if "px" in x.columns:
        models.double_rate(x).write.mode("overwrite").parquet(a.output)
        return 0
    job = config.from_yaml(a.profile) if a.profile else config.JobConfig()
    job.model = a.model or job.model
    with Performance() as p:
        p.watch(models.double_frames(x, job)).write.mode("overwrite").parquet(a.output)
    p.report(spark, job.target_fps).write.mode("overwrite").json(f"{a.output.rstrip('/')}-performance")
    return 0


#: What a comparison of models shows.
COMPARED = ("quality", "quality_status", "technical_status", "performance", "realtime_factor", "opinion", "ball", "player", "occlusion", "psnr", "added_ghosting", "recommendation")


def compared(reports_of: dict):
    """{model: scores} -> (clip_id, metric, model, value) of every clip, metric and model, values as text."""
    out = None
    for name, x in reports_of.items():
        values = F.create_map(*[v for c in COMPARED for v in (F.lit(c), F.col(c).cast("string"))])
        rows = x.select("clip_id", F.lit(name).alias("model"), F.explode(values).alias("metric", "value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def benchmark(spark, a) -> int:
    """Outputs of several models (NAME=PATH,...) against one source: a report each, and one table with a column a model."""
    paths = dict(x.split("=", 1) for x in a.models.split(",") if "=" in x)
    if not paths:
        print("no models: give NAME=PATH,NAME=PATH", file=sys.stderr)
        return 1
    source, meta, done = spark.read.parquet(a.source), _meta(spark, a.source_probe), {}
    for name, path in paths.items():
        output = spark.read.parquet(path)
        scores = E.evaluate(source, output, meta, _meta(spark, a.output_probe), config=E.Config(max_frames=a.max_frames))
        scores.write.mode("overwrite").json(f"{a.report}/{name}")
        done[name] = spark.read.schema(scores.schema).json(f"{a.report}/{name}")
    wide = compared(done).groupBy("clip_id", "metric").pivot("model", list(done)).agg(F.first("value"))
    wide.write.mode("overwrite").option("header", True).csv(f"{a.report}/comparison")
    return 0


def ground_truth(spark, a) -> int:
    E.ground_truth(spark.read.parquet(a.truth), spark.read.parquet(a.output), a.max_frames).write.mode("overwrite").json(a.report)
    return 0


def inspect(spark, a) -> int:
    """Pictures to look at in a folder that executors mount: generated frames, differences from the source, and slow time stamps."""
    source, output = spark.read.parquet(a.source), spark.read.parquet(a.output)
    images.write_images(frames.first_generated(output, a.frames), f"{a.report}/generated")
    shown = frames.first_output(output, a.frames)
    images.write_images(images.heat_maps(source.withColumn("frame_idx", 2 * F.col("frame_idx")), shown), f"{a.report}/differences")
    for factor in a.slow.split(","):
        images.slow_motion(shown.select("clip_id", "frame_idx"), a.target_fps, float(factor)).write.mode("overwrite").json(f"{a.report}/slow-{factor.strip()}")
    return 0


def deflicker(spark, a) -> int:
    vision.deflicker(spark.read.parquet(a.input), a.margin).write.mode("overwrite").parquet(a.output)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cadenza", description=__doc__.split("\n")[0])
    kinds = p.add_subparsers(dest="command", required=True)

    def command(run, name, *paths):
        c = kinds.add_parser(name)
        c.set_defaults(run=run)
        for x in paths:
            c.add_argument(f"--{x}", required=True)
        return c

    c = command(evaluate, "evaluate", "source", "output", "source-probe", "output-probe", "report")
    c.add_argument("--max-frames", type=int)
    c.add_argument("--sample-stride", type=int, default=1)
    c.add_argument("--target-fps", type=float, default=50.0)
    c.add_argument("--packets", help="folder of packet JSON, named after the clips")
    command(football, "football", "output", "report").add_argument("--max-frames", type=int)
    command(read_meta, "probe", "input", "report")
    c = command(double, "double", "input", "output")
    c.add_argument("--model", choices=models.names())
    c.add_argument("--profile", help="YAML settings")
    command(benchmark, "benchmark", "source", "models", "source-probe", "output-probe", "report").add_argument("--max-frames", type=int)
    command(ground_truth, "ground-truth", "truth", "output", "report").add_argument("--max-frames", type=int)
    c = command(inspect, "inspect", "source", "output", "report")
    c.add_argument("--frames", type=int, default=20)
    c.add_argument("--slow", default="2,4")
    c.add_argument("--target-fps", type=float, default=50.0)
    command(deflicker, "deflicker", "input", "output").add_argument("--margin", type=float, default=10.0)
    return p


def main(args=None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    return a.run(spark or SparkSession.builder.appName("cadenza").getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
