"""Chunk accumulators: order, borders, and what a change reads."""
import random

import numpy as np
from pyspark.sql import functions as F

from cadenza.plans import partials as P

SCHEMA = "clip_id string, frame_idx long, x double"


def clips(seed=1, n=200):
    rng = random.Random(seed)
    rows = {(c, i): rng.uniform(-20, 300) for c in ("a", "b") for i in range(n)}
    # chunks of one frame, chunks that are missing, a clip of one frame, a null clip
    rows = {k: v for k, v in rows.items() if k[0] == "a" or k[1] % 10 == 3 or 40 < k[1] < 75}
    return {**rows, ("one", 7): 5.0, (None, 1): 1.0, (None, 2): 4.0, (None, 30): 2.0}


def plain(rows):
    out = {}
    for c in {k[0] for k in rows}:
        x = np.array([v for k, v in sorted(((k[1], v) for k, v in rows.items() if k[0] == c))])
        step, bend = np.abs(np.diff(x)), np.abs(x[1:-1] - (x[:-2] + x[2:]) / 2)
        hist = np.bincount(np.clip(x // 8, 0, 31).astype(int), minlength=32)
        out[c] = (len(x), x.mean(), x.std(), x.max(), step.mean() if len(step) else 0.0, bend.mean() if len(bend) else 0.0, hist.tolist())
    return out


def check(merged, rows):
    got, want = {r.clip_id: r for r in merged.collect()}, plain(rows)
    assert set(got) == set(want)
    for c, w in want.items():
        g = got[c]
        assert (g.n, list(g.histogram)) == (w[0], w[6])
        assert np.allclose([g["mean"], g.sd, g.most, g.step, g.bend], w[1:6], atol=1e-6)


def frame(spark, rows):
    return spark.createDataFrame([(*k, v) for k, v in rows.items()], SCHEMA)


def test_merged_in_any_order(spark):
    rows = clips()
    states = P.chunk_states(frame(spark, rows), 10)
    check(P.merge_states(states), rows)
    parts = [states.filter(F.pmod(F.xxhash64("clip_id", "chunk_id"), F.lit(3)) == k) for k in (2, 0, 1)]
    check(P.merge_states(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[0])), rows)  # a part that was added twice
    assert P.merge_states(states.limit(0)).count() == 0


def test_a_changed_chunk_is_read_alone(spark, tmp_path):
    rows, src, path = clips(), str(tmp_path / "frames"), str(tmp_path / "states")
    frame(spark, rows).repartitionByRange(4, "clip_id", "frame_idx").sortWithinPartitions("clip_id", "frame_idx").write.parquet(src)
    assert P.append_states(spark.read.parquet(src), path, size=10) == 0
    rows |= {("a", i): 0.5 for i in range(50, 60)}
    rows[None, 30] = 9.0
    frame(spark, rows).write.mode("overwrite").parquet(src)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    x = spark.read.parquet(src)
    near = x.filter("clip_id = 'a' AND frame_idx BETWEEN 50 AND 59 OR clip_id IS NULL AND frame_idx BETWEEN 30 AND 39")
    assert P.append_states(x, path, [("a", 5), (None, 3)], size=10) == 1
    added = P.read_states(spark, path, latest=False).filter("version = 1")
    assert sorted((str(r.clip_id), r.chunk_id, r.n) for r in added.collect()) == [("None", 3, 1), ("a", 5, 10)]
    near.mapInArrow(count, SCHEMA).count()
    assert seen.value == 11  # the rows of the changed chunks
    check(P.merge_states(P.read_states(spark, path)), rows)
