"""Frame interpolators with a life cycle: loaded once a task, fed in batches of their size, unloaded at the end.

A back end is a class with load(), interpolate_batch(a, b) and unload() under a name. Its weights and
libraries are its own; none are part of this package.
"""
import contextlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators import vision
from cadenza.operators.frames import blend
from cadenza.sources.config import JobConfig

FRAME = "clip_id string, frame_idx long, h int, w int, c int, data binary"
SCHEMA = pa.schema([("clip_id", pa.string()), ("frame_idx", pa.int64()), ("h", pa.int32()), ("w", pa.int32()), ("c", pa.int32()), ("data", pa.binary())])
_MODELS: dict[str, Callable] = {}


class Interpolator:
    """What a task does with a model; batch_size is how many pairs of frames of one shape it is given at once."""

    batch_size = 8

    def load(self) -> None:
        """Once a task, before its first pair."""

    def interpolate_batch(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """(n, h, w, c) bytes of the frames before and after -> those between."""
        raise NotImplementedError

    def unload(self) -> None:
        """Once a task, whatever ended it."""


def register(*names):
    def put(made):
        _MODELS.update(dict.fromkeys(names, made))
        return made

    return put


def names():
    return sorted(_MODELS)


def get(name) -> Callable:
    if name not in _MODELS:
        raise KeyError(f"{name}: known models are {', '.join(names())}; register() adds a back end of your own")
    return _MODELS[name]


@register("blend", "dummy", "bwdif", "deinterlace")
class Blend(Interpolator):
    """The mean of both frames, to the nearest value and half up."""

    def interpolate_batch(self, a, b):
        return ((a.astype(np.uint16) + b + 1) // 2).astype(np.uint8)


def task_profile(cpus: int = 1, gpus: float = 0) -> ResourceProfile:
    """What each task of an interpolation asks of the cluster; local masters have no profiles but the default one."""
    ask = TaskResourceRequests().cpus(cpus)
    return ResourceProfileBuilder().require(ask.resource("gpu", gpus) if gpus else ask).build


def route(a, b, c: JobConfig) -> str:
    """How the frame between a and b is made: cut (a is shown again), blend, repeat (a duplicate) or model."""
    apart = vision.frame_difference(a, b)
    if apart >= c.scene_threshold:
        return "cut"
    if apart >= c.transition_threshold:
        return "blend"
    return "repeat" if c.cadence_filter and np.abs(a.astype(float) - b).mean() < 0.8 else "model"


def _between(made, c: JobConfig):
    def run(batches):
        with contextlib.ExitStack() as life:
            model, waiting = None, []
            size = 0

            def flush():
                keys, first, second = zip(*waiting)
                mids = model.interpolate_batch(np.stack(first), np.stack(second))
                out = [emit(k, a, m, b) for k, a, m, b in zip(keys, first, mids, second)]
                waiting.clear()
                return pa.RecordBatch.from_pylist(out, schema=SCHEMA)

            def emit(key, a, mid, b):
                mid = vision.clamp_envelope(a, mid.astype(float), b).round().astype(np.uint8) if c.anti_flicker else mid
                return dict(zip(SCHEMA.names, (*key, *mid.shape, mid.tobytes())))

            for batch in batches:
                for i in range(batch.num_rows):
                    r = batch.slice(i, 1).to_pylist()[0]
                    a, b = (np.frombuffer(r[k], np.uint8).reshape(r["h"], r["w"], r["c"]) for k in ("data", "after"))
                    key, way = (r["clip_id"], 2 * r["frame_idx"] + 1), route(a, b, c)
                    if way != "model":
                        mid = Blend().interpolate_batch(a, b) if way == "blend" else a
                        yield pa.RecordBatch.from_pylist([emit(key, a, mid, b)], schema=SCHEMA)
                        continue
                    if model is None:
                        model = made()
                        life.callback(model.unload)
                        model.load()
                        size = c.batch_size or model.batch_size
                    if waiting and waiting[0][1].shape != a.shape:
                        yield flush()
                    waiting.append((key, a, b))
                    if len(waiting) == size:
                        yield flush()
            if waiting:
                yield flush()

    return run


def double_frames(frames: DataFrame, config: JobConfig = JobConfig(), profile: ResourceProfile | None = None) -> DataFrame:
    """frames(clip_id, frame_idx, h, w, c, data) -> at twice the rate: 2k is frame k, 2k+1 lies between k and k+1.

    Pairs come by an equi-join, so a clip is dealt over all tasks; a pair of different shapes repeats the
    first frame. Scenes that change repeat it too, transitions are blended, the rest goes to config.model in
    batches that run on over Arrow's. profile: resources of the tasks that hold a model, see task_profile().
    """
    cols = ["h", "w", "c", "data"]
    nxt = frames.select(F.col("clip_id").alias("of_clip"), (F.col("frame_idx") - 1).alias("before"), *[F.col(k).alias(f"{k}2") for k in cols])
    pair = frames.join(nxt, F.col("clip_id").eqNullSafe(F.col("of_clip")) & (F.col("frame_idx") == F.col("before")))
    alike = (F.col("h") == F.col("h2")) & (F.col("w") == F.col("w2")) & (F.col("c") == F.col("c2"))
    pair = pair.select("clip_id", "frame_idx", *cols, F.when(alike, F.col("data2")).otherwise(F.col("data")).alias("after"))
    mid = pair.mapInArrow(_between(get(config.model), config), FRAME, profile=profile)
    return frames.select("clip_id", (2 * F.col("frame_idx")).alias("frame_idx"), *cols).unionByName(mid)


def double_rate(frames: DataFrame) -> DataFrame:
    """frames(clip_id, frame_idx, px) -> the same for pixel arrays, blended in the JVM."""
    nxt = frames.select("clip_id", (F.col("frame_idx") - 1).alias("frame_idx"), F.col("px").alias("after"))
    mid = frames.join(nxt, ["clip_id", "frame_idx"]).select("clip_id", (2 * F.col("frame_idx") + 1).alias("frame_idx"), blend(F.col("px"), F.col("after")).alias("px"))
    return frames.select("clip_id", (2 * F.col("frame_idx")).alias("frame_idx"), "px").unionByName(mid)
