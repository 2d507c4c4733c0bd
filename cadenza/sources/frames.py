"""Raw frame containers: files of packed frames, read by range and written as sorted Parquet."""
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class RawFrames(DataSource):
    """Format raw_frames: frames of fixed size packed in files of a mounted folder, read by byte range.

    Options: path (a file or folder that driver and executors both mount), height, width, channels (3),
    start (0), count (all), frames_per_task (64). A task seeks to its first frame and reads no other
    bytes, so a file may have any size; a short last frame is left out. Use read_raw for other stores.
    """

    @classmethod
    def name(cls):
        return "raw_frames"

    def schema(self):
        return "clip_id string, frame_idx long, h int, w int, c int, data binary"

    def reader(self, schema):
        return RawFramesReader(self.options)


class FrameRange(InputPartition):
    def __init__(self, path, start, end):
        self.path, self.start, self.end = path, start, end


class RawFramesReader(DataSourceReader):
    def __init__(self, options):
        get = lambda k, default=None: int(options.get(k, default))
        self.path, self.shape = options["path"], (get("height"), get("width"), get("channels", 3))
        self.start, self.count, self.step = get("start", 0), options.get("count"), get("frames_per_task", 64)
        self.size = self.shape[0] * self.shape[1] * self.shape[2]

    def partitions(self):
        files = sorted(os.path.join(self.path, f) for f in os.listdir(self.path)) if os.path.isdir(self.path) else [self.path]
        out = []
        for f in files:
            end = os.path.getsize(f) // self.size
            end = end if self.count is None else min(end, self.start + int(self.count))
            out += [FrameRange(f, k, min(end, k + self.step)) for k in range(self.start, end, self.step)]
        return out

    def read(self, part):
        if part is None or not hasattr(part, "path"):  # no files, or none with a frame
            return
        clip = os.path.splitext(os.path.basename(part.path))[0]
        with open(part.path, "rb") as f:
            f.seek(part.start * self.size)
            for k in range(part.start, part.end):
                yield clip, k, *self.shape, f.read(self.size)


def read_raw(spark: SparkSession, path: str, height: int, width: int, channels: int = 3, start: int = 0, count: int | None = None) -> DataFrame:
    """Row per frame (clip_id, frame_idx, h, w, c, data); a short last frame is left out. A file is at most 2 GB."""
    size = height * width * channels
    f = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("clip_id"), "content")
    total = F.floor(F.length("content") / size)
    end = total if count is None else F.least(total, F.lit(start + count))
    f = f.withColumn("end", end).filter(F.col("end") > start)
    f = f.select("clip_id", "content", F.explode(F.sequence(F.lit(start).cast("long"), F.col("end") - 1)).alias("frame_idx"))
    cut = F.substring("content", (F.col("frame_idx") * size + 1).cast("int"), F.lit(size))
    return f.select("clip_id", "frame_idx", F.lit(height).alias("h"), F.lit(width).alias("w"), F.lit(channels).alias("c"), cut.alias("data"))


def write_frames(frames: DataFrame, path: str, tasks: int | None = None) -> None:
    """Parquet in order of clip and frame, so that ranges skip row groups."""
    key = ["clip_id", "frame_idx"]
    dealt = frames.repartitionByRange(tasks, *key) if tasks else frames.repartitionByRange(*key)
    dealt.sortWithinPartitions(*key).write.mode("overwrite").parquet(path)


def first_generated(frames: DataFrame, n: int) -> DataFrame:
    """The first n generated (odd) frames of each clip: odd indices below 2n, no sort needed."""
    return frames.filter((F.col("frame_idx") % 2 == 1) & (F.col("frame_idx") < 2 * n))


def first_output(frames: DataFrame, source_frames: int) -> DataFrame:
    """The output of the first source frames: indices below twice their number."""
    return frames.filter(F.col("frame_idx") < 2 * source_frames)


def merge_chunks(parts: DataFrame) -> DataFrame:
    """parts(clip_id, chunk_id, local_idx, ...): chunks share their border frame, which all but the first leave out."""
    return parts.filter(~((F.col("chunk_id") > 0) & (F.col("local_idx") == 0)))
