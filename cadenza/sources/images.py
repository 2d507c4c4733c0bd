"""Image and clip sinks: frames as PNG files, coloured differences, two clips side by side, slow motion."""
import os
import struct
import zlib
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from cadenza.sources.packed import StagedWriter, Written

FRAME = "clip_id string, frame_idx long, h int, w int, c int, data binary"
SCHEMA = pa.schema([("clip_id", pa.string()), ("frame_idx", pa.int64()), ("h", pa.int32()), ("w", pa.int32()), ("c", pa.int32()), ("data", pa.binary())])


def png(pixels: np.ndarray) -> bytes:
    """An array (h, w, 1 or 3) of bytes as a PNG file."""
    h, w, c = pixels.shape
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    lines = np.concatenate([np.zeros((h, 1), np.uint8), pixels.reshape(h, w * c)], axis=1)  # each line opens with its filter: none
    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2}[c], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines.tobytes())) + part(b"IEND", b"")


class PngFrames(DataSource):
    """Format png_frames: one file a frame, clip=NAME/FRAME.png, in a folder that all executors mount.

    Tasks write into a folder of the job; commit moves each file to its place, an abort leaves nothing.
    """

    @classmethod
    def name(cls):
        return "png_frames"

    def schema(self):
        return FRAME

    def writer(self, schema, overwrite):
        return PngWriter(self.options["path"], overwrite)


class PngWriter(StagedWriter):
    def write(self, rows):
        from pyspark import TaskContext

        task, names = TaskContext.get().taskAttemptId(), []
        for r in rows:
            name = os.path.join(f"clip={quote(str(r.clip_id), safe='')}", f"{r.frame_idx:08d}.png")
            own = os.path.join(self.job, str(task), name)
            os.makedirs(os.path.dirname(own), exist_ok=True)
            with open(own, "wb") as f:
                f.write(png(np.frombuffer(bytes(r.data), np.uint8).reshape(r.h, r.w, r.c)))
            names.append(name)
        return Written((task, names))

    def commit(self, messages):
        for m in messages:
            for name in m.clips[1] if m else ():
                os.makedirs(os.path.dirname(os.path.join(self.path, name)), exist_ok=True)
                os.replace(os.path.join(self.job, str(m.clips[0]), name), os.path.join(self.path, name))
        self.clear()


def write_images(frames: DataFrame, path: str) -> None:
    """frames(clip_id, frame_idx, h, w, c, data) as PNG files; filter them first, with first_generated for instance."""
    frames.sparkSession.dataSource.register(PngFrames)
    frames.select("clip_id", "frame_idx", "h", "w", "c", "data").write.format("png_frames").mode("append").save(path)


def jet(v):
    """0..1 from blue over green and yellow to red."""
    return (np.clip(1.5 - np.abs(4 * (v[..., None] - np.array([0.75, 0.5, 0.25]))), 0, 1) * 255).astype(np.uint8)


def _joined(a: DataFrame, b: DataFrame, alike: str, made) -> DataFrame:
    """Frames that both sides have, where `alike` (SQL on h, w, c and h2, w2, c2) holds, as made(pixels, pixels)."""
    other = b.select("clip_id", "frame_idx", *[F.col(k).alias(f"{k}2") for k in ("h", "w", "c", "data")])
    both = a.select("clip_id", "frame_idx", "h", "w", "c", "data").join(other, ["clip_id", "frame_idx"]).filter(alike)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                out = made(*(np.frombuffer(r[f"data{k}"], np.uint8).reshape(r[f"h{k}"], r[f"w{k}"], r[f"c{k}"]) for k in ("", "2")))
                yield pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, (r["clip_id"], r["frame_idx"], *out.shape, out.tobytes())))], schema=SCHEMA)

    return both.mapInArrow(run, FRAME)


def heat_maps(a: DataFrame, b: DataFrame, gain: float = 3.0) -> DataFrame:
    """Mean difference of the channels, times gain, coloured; frames of different shapes are left out."""

    def made(x, y):
        return jet(np.clip(np.abs(x.astype(float) - y).mean(-1) * gain / 255, 0, 1))

    return _joined(a, b, "h = h2 AND w = w2 AND c = c2", made)


def side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Frames of equal index next to each other; frames of different heights or channels are left out."""
    return _joined(a, b, "h = h2 AND c = c2", lambda x, y: np.concatenate([x, y], axis=1))


def slow_motion(frames: DataFrame, fps: float, factor: float = 4.0) -> DataFrame:
    """+ pts: when a frame is shown if the clip runs `factor` times as long."""
    return frames.withColumn("pts", F.col("frame_idx") / fps * factor)
