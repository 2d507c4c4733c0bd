"""Structured Streaming twins of the sequence operators: a keyed window over the last two rows."""
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from cadenza.session import shared_dir

OUT = "clip_id string, event_id long, x double, x1 double, x2 double"
STATE = "x1 double, x2 double"


def triplets(stream: DataFrame) -> DataFrame:
    """stream(clip_id, ts, event_id, x) -> each row with the two before it in its clip.

    Rows of a clip are sorted by (ts, event_id) within a micro-batch; batches must arrive in that
    order. State is two numbers a clip. Null clip ids form a clip of their own.
    """

    def step(key, batches, state):
        x1, x2 = state.get if state.exists else (None, None)
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"], kind="stable")
        x = rows["x"].astype(float).reset_index(drop=True)
        past = pd.concat([pd.Series([x2, x1], dtype=float), x], ignore_index=True)
        state.update(tuple(None if pd.isna(v) else float(v) for v in (past.iloc[-1], past.iloc[-2])))
        yield pd.DataFrame({"clip_id": key[0], "event_id": rows["event_id"].to_numpy(), "x": x, "x1": past[1:-1].to_numpy(), "x2": past[:-2].to_numpy()})

    return stream.groupBy("clip_id").applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def stream_second_order(spark, sf_dir):
    """Second-order residual from a stream of the events table, run until its files are read."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    # a pattern, as a stream's path may name a single file only that way
    ev = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]").select(F.col("event_type").alias("clip_id"), "ts", "event_id", F.col("value").alias("x"))
    q = triplets(ev).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.schema(OUT).parquet(out).filter("x2 is not null")
    return rows.select("clip_id", "event_id", F.round(F.abs(F.col("x1") - (F.col("x2") + F.col("x")) / 2), 6).alias("resid"))


def lockstep(source: DataFrame, output: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Two streams(clip_id, frame_idx, ts, x) side by side: rows of equal clip and frame -> clip_id, frame_idx, x, y.

    Partners may be up to `late` apart in event time; a frame without one leaves the state when the
    watermark has passed it by that much. Rows with a null clip, frame or time have no partner.
    """
    a = source.withWatermark("ts", late)
    b = output.select(F.col("clip_id").alias("clip2"), F.col("frame_idx").alias("frame2"), F.col("ts").alias("ts2"), F.col("x").alias("y")).withWatermark("ts2", late)
    near = F.expr(f"ts2 >= ts - interval {late} AND ts2 <= ts + interval {late}")
    return a.join(b, (F.col("clip_id") == F.col("clip2")) & (F.col("frame_idx") == F.col("frame2")) & near).select("clip_id", "frame_idx", "x", "y")


def stream_lockstep(spark, sf_dir):
    """Source frame k beside output frame 2k, as two streams of the events table; odd output frames find no partner."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    read = lambda: spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))
    source = read().filter("event_id % 2 = 0").select(F.col("event_type").alias("clip_id"), F.col("event_id").alias("frame_idx"), "ts", F.col("value").alias("x"))
    output = read().select(F.col("event_type").alias("clip_id"), F.col("event_id").alias("frame_idx"), "ts", (F.col("value") * 0.98 + 1).alias("x"))
    q = lockstep(source, output).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.schema("clip_id string, frame_idx long, x double, y double").parquet(out)
    return rows.select("clip_id", F.expr("frame_idx div 2").alias("k"), F.round(F.abs(F.col("x") - F.col("y")), 6).alias("d"))


QUERIES = {"stream_second_order": stream_second_order, "stream_lockstep": stream_lockstep}
ORACLES = {
    "stream_lockstep": "SELECT s.event_type AS clip_id, s.event_id // 2 AS k, round(abs(s.value - (o.value * 0.98 + 1)), 6) AS d FROM events s JOIN events o ON s.event_id = o.event_id AND s.event_type = o.event_type WHERE s.event_id % 2 = 0",
"stream_second_order": "WITH l AS (SELECT event_type AS clip_id, event_id, value AS x, lag(value, 1) OVER w AS x1, lag(value, 2) OVER w AS x2 FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)) SELECT clip_id, event_id, round(abs(x1 - (x2 + x) / 2), 6) AS resid FROM l WHERE x2 IS NOT NULL"}
