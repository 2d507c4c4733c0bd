"""Throughput of a pass, counted while it runs: no second read of what it made."""
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cadenza.plans import scoring


class Performance:
    """with Performance() as p: p.watch(frames).write...; then p.report(...).

    Frames, generated frames and bytes are observed by the tasks that made them; seconds are those of the
    block. The counts are there after the first action on the watched frames.
    """

    def __init__(self):
        self.seen, self.seconds = Observation(), None

    def __enter__(self):
        self.began = time.perf_counter()
        return self

    def __exit__(self, *_):
        self.seconds = time.perf_counter() - self.began

    def watch(self, frames: DataFrame) -> DataFrame:
        size = F.sum(F.octet_length("data")) if "data" in frames.columns else F.lit(None).cast("long")
        return frames.observe(self.seen, F.count(F.lit(1)).alias("frames"), F.count_if(F.col("frame_idx") % 2 == 1).alias("generated"), size.alias("bytes"))

    def report(self, spark: SparkSession, fps: float = 50.0) -> DataFrame:
        """One row: frames, generated, bytes, seconds, frames_per_second, realtime_factor (by the frames' duration at fps), score, status."""
        n = self.seen.get
        took = max(0.001, self.seconds)
        row = [(n["frames"], n["generated"], n["bytes"], self.seconds, n["frames"] / took, took / max(0.001, n["frames"] / fps))]
        x = spark.createDataFrame(row, "frames long, generated long, bytes long, seconds double, frames_per_second double, realtime_factor double")
        score, status = scoring.performance(F.col("realtime_factor"))
        return x.withColumns({"score": score, "status": status})
