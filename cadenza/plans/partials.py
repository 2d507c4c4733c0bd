"""Accumulators of chunks: a stored table of partial states that merge in any order.

A chunk's state holds counts, sums, squares, a histogram and its first and last two frames, so that what
lies across the border of two chunks is added when states meet. States are only ever appended, each with
a version; the newest of a chunk counts. Changing a chunk reads and adds that chunk alone.
"""
import functools
import operator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.session import table

BINS, WIDTH = 32, 8.0


def chunk_states(frames: DataFrame, size: int = 4096, version: int = 0) -> DataFrame:
    """frames(clip_id, frame_idx, x) -> one row a chunk of `size` frame numbers; frames follow each other by frame_idx, values are not null."""
    own = W.partitionBy("clip_id", "chunk_id")
    up, down = own.orderBy("frame_idx"), own.orderBy(F.desc("frame_idx"))
    x = frames.select("clip_id", F.floor(F.col("frame_idx") / size).cast("long").alias("chunk_id"), "frame_idx", F.col("x").cast("double").alias("x"))
    x = x.withColumns({"x1": F.lag("x", 1).over(up), "x2": F.lag("x", 2).over(up), "i": F.row_number().over(up), "j": F.row_number().over(down)})
    ends = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col(k) <= 2, F.struct("frame_idx", "x")))), lambda s: s["x"])
    place = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor(F.col("x") / WIDTH)))
    return x.groupBy("clip_id", "chunk_id").agg(
        F.lit(version).cast("long").alias("version"), F.count("*").alias("n"), F.sum("x").alias("total"), F.sum(F.col("x") * F.col("x")).alias("squares"), F.max("x").alias("most"),
        F.array(*[F.count_if(place == k) for k in range(BINS)]).alias("histogram"), F.count("x1").alias("steps"), F.coalesce(F.sum(F.abs(F.col("x") - F.col("x1"))), F.lit(0.0)).alias("step_sum"),
        F.count("x2").alias("triples"), F.coalesce(F.sum(F.abs(F.col("x1") - (F.col("x2") + F.col("x")) / 2)), F.lit(0.0)).alias("bend_sum"), ends("i").alias("first"), ends("j").alias("last"))


def append_states(frames: DataFrame, path: str, changed: list[tuple[str, int]] | None = None, size: int = 4096) -> int:
    """Adds the states of all chunks, or of the changed (clip_id, chunk_id), to the table at path; returns their version.

    The frames of changed chunks are chosen by ranges of frame_idx, which reach the scan.
    """
    spark = frames.sparkSession
    version = 0
    if changed is not None:
        version = (read_states(spark, path, latest=False).agg(F.max("version")).first()[0] or 0) + 1
        near = [(F.col("clip_id").eqNullSafe(F.lit(c))) & F.col("frame_idx").between(k * size, (k + 1) * size - 1) for c, k in changed]
        frames = frames.filter(functools.reduce(operator.or_, near, F.lit(False)))
    chunk_states(frames, size, version).write.mode("append").parquet(path)
    return version


def read_states(spark: SparkSession, path: str, latest: bool = True) -> DataFrame:
    """The newest state of each chunk, or every one that was ever added. A state that was added twice counts once."""
    x = spark.read.parquet(path)
    return newest(x) if latest else x


def newest(states: DataFrame) -> DataFrame:
    rest = [c for c in states.columns if c not in ("clip_id", "chunk_id")]
    x = states.groupBy("clip_id", "chunk_id").agg(F.max_by(F.struct(*rest), "version").alias("s"))
    return x.select("clip_id", "chunk_id", *[f"s.{c}" for c in rest])


def merge_states(states: DataFrame) -> DataFrame:
    """States in any order -> a row a clip: n, mean, sd, most, histogram, step (mean lag-1 difference), bend (mean second-order residual).

    One small row a chunk is ordered; every chunk has a frame, so the two before it hold what its border needs.
    """
    by = W.partitionBy("clip_id").orderBy("chunk_id")
    none = F.array().cast("array<double>")
    before = F.concat(F.coalesce(F.lag("last", 2).over(by), none), F.coalesce(F.lag("last", 1).over(by), none))
    x = newest(states).withColumn("before", before)
    x = x.withColumn("before", F.slice("before", F.greatest(F.lit(1), F.size("before") - 1), F.lit(2)))
    t2, t1 = F.get("before", F.size("before") - 1), F.get("before", F.size("before") - 2)
    h1, h2 = F.get("first", F.lit(0)), F.get("first", F.lit(1))
    bends = [F.abs(t2 - (t1 + h1) / 2), F.abs(h1 - (t2 + h2) / 2)]
    nil, zero = F.lit(0), F.lit(0.0)
    has = F.when(F.size("before") > 0, t2)  # null where the clip begins
    x = x.withColumns({
        "steps": F.col("steps") + F.when(has.isNotNull(), 1).otherwise(nil), "step_sum": F.col("step_sum") + F.coalesce(F.abs(h1 - has), zero),
        "triples": F.col("triples") + sum((F.when(b.isNotNull(), 1).otherwise(nil) for b in bends), nil), "bend_sum": F.col("bend_sum") + sum((F.coalesce(b, zero) for b in bends), zero),
    })
    t = x.groupBy("clip_id").agg(
        *[F.sum(k).alias(k) for k in ("n", "total", "squares", "steps", "step_sum", "triples", "bend_sum")], F.max("most").alias("most"), F.array(*[F.sum(F.get("histogram", F.lit(k))) for k in range(BINS)]).alias("histogram"))
    mean = F.col("total") / F.col("n")
    per = lambda s, k: F.when(F.col(k) > 0, F.col(s) / F.col(k)).otherwise(0.0)
    return t.select("clip_id", "n", mean.alias("mean"), F.sqrt(F.greatest(zero, F.col("squares") / F.col("n") - mean * mean)).alias("sd"), "most", "histogram", per("step_sum", "steps").alias("step"), per("bend_sum", "triples").alias("bend"))


def chunk_accumulators(spark, sf_dir):
    """Clips of the events table, odd chunks and even chunks apart, merged. What lies half way between two roundings goes up, whatever the order of sums."""
    from cadenza.plans.catalog import EV_SPLIT

    ev = spark.sql(f"WITH {EV_SPLIT} SELECT clip_id, frame_idx, x FROM ev", events=table(spark, sf_dir, "events"))
    states = chunk_states(ev, 300)
    x = merge_states(states.filter("chunk_id % 2 = 1").unionByName(states.filter("chunk_id % 2 = 0")))
    return x.select("clip_id", "n", *[F.round(F.col(k) + 1e-9, 5).alias(k) for k in ("mean", "sd", "most", "step", "bend")], F.array_join("histogram", ",").alias("histogram"))


QUERIES = {"chunk_accumulators": chunk_accumulators}
ORACLES = {
    "chunk_accumulators": f"""WITH l AS (SELECT event_type AS clip_id, value AS x, lag(value, 1) OVER w AS x1, lag(value, 2) OVER w AS x2 FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))
SELECT clip_id, count(*) AS n, round(avg(x) + 1e-9, 5) AS mean, round(stddev_pop(x) + 1e-9, 5) AS sd, round(max(x) + 1e-9, 5) AS most, round(avg(abs(x - x1)) + 1e-9, 5) AS step, round(avg(abs(x1 - (x2 + x) / 2)) + 1e-9, 5) AS bend,
 array_to_string([{", ".join(f"count_if(greatest(0, least({BINS - 1}, floor(x / {WIDTH}))) = {k})" for k in range(BINS))}], ',') AS histogram FROM l GROUP BY clip_id""",
}
