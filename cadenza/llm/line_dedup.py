"""Line dedup by a sharded minimal perfect hash.

Keys of repeated lines are hashed to 128 bits: 64 bits address a slot of a minimal perfect
hash of one shard, 64 are its fingerprint; count and largest doc_id stand beside it. Documents
probe these arrays at every size. Only how the two meet depends on the arrays' measured size: up to
broadcast_bytes the arrays go to all tasks, beyond it hashes of lines and arrays are dealt by shard.

Defined results: a row is a document (repeated doc_ids count by row; all rows of the largest
doc_id keep their lines); a null doc_id is below every other; null or empty text is one empty line;
other columns stay as they are, whatever their names, but n_lines and n_dropped are replaced.
"""
import pickle
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import cols, materialise, quoted, slices, text_udf

LOW = -(2**63)
#: Levels of a perfect hash; past them only keys with equal first halves are left, which a sorted list takes.
LEVELS = 24


def _keys(text: bytes, min_chars: int):
    """Hash of each line's key, or None where the key is too short."""
    import xxhash

    out = []
    for line in text.lower().split(b"\n"):
        k = line.strip(b" \t\n\r\x0b\x0c")
        n = len(k)
        if n < min_chars or n < 4 * min_chars and len(k.decode("utf-8", "replace")) < min_chars:
            out.append(None)
        else:
            out.append(xxhash.xxh3_128_digest(k))
    return out


def _mix(h, level):
    import numpy as np

    x = h ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def build_mph(h1, h2):
    """(levels, rest): bit arrays in words of 64 with the rank before each word, then the keys that no level parts.

    h1, h2: unsigned halves of distinct keys. Every key gets its own slot from 0 to n - 1.
    """
    import numpy as np

    levels, at_rest, base = [], np.arange(len(h1)), 0
    while len(at_rest) and len(levels) < LEVELS:
        m = -(-2 * len(at_rest) // 64) * 64
        at = (_mix(h1[at_rest], len(levels)) % np.uint64(m)).astype(np.int64)
        bits = np.bincount(at, minlength=m) == 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        ranks = base + np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]])
        levels.append((m, words, ranks))
        base += int(bits.sum())
        at_rest = at_rest[~bits[at]]
    return levels, {(int(a), int(b)): base + i for i, (a, b) in enumerate(zip(h1[at_rest], h2[at_rest]))}


def look_up(mph, h1, h2):
    """Slot of each key; -1 where no level holds it. A foreign key may get a slot, which its fingerprint tells."""
    import numpy as np

    levels, rest = mph
    slot, todo = np.full(len(h1), -1, np.int64), np.arange(len(h1))
    for level, (m, words, ranks) in enumerate(levels):
        if not len(todo):
            break
        at = (_mix(h1[todo], level) % np.uint64(m)).astype(np.int64)
        word, bit = words[at >> 6], (at & 63).astype(np.uint64)
        hit = (word >> bit) & np.uint64(1) == 1
        below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        slot[todo[hit]] = (ranks[at >> 6] + below)[hit]
        todo = todo[~hit]
    if rest:
        for i in todo.tolist():
            slot[i] = rest.get((int(h1[i]), int(h2[i])), -1)
    return slot


def _build(pdf):
    import numpy as np
    import pandas as pd

    h1, h2 = pdf["h1"].to_numpy().view(np.uint64), pdf["h2"].to_numpy().view(np.uint64)
    mph = build_mph(h1, h2)
    slot = look_up(mph, h1, h2)
    fp, n, top = np.zeros(len(h1), np.uint64), np.zeros(len(h1), np.uint32), np.zeros(len(h1), np.int64)
    fp[slot], n[slot], top[slot] = h2, np.minimum(pdf["n"], 2**32 - 1), pdf["top"]
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "arrays": [pickle.dumps((mph, fp, n, top))]})


def probe(arrays, h1, h2):
    """(found, largest doc_id) of each key in one shard's arrays."""
    mph, fp, _, top = arrays
    slot = look_up(mph, h1, h2)
    return (slot >= 0) & (fp[slot] == h2), top[slot]


def _halves(keys):
    import numpy as np

    h = np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
    return np.ascontiguousarray(h[:, 0]), np.ascontiguousarray(h[:, 1])


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(h1, h2, n, top) of keys in at least min_docs documents; counted in each slice before the shuffle."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for at, size in slices(b.column(1)):
                part, seen = b.slice(at, size), {}
                for d, t in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    d = LOW if d is None else d
                    for k in set(_keys(t or b"", min_chars)):
                        if k is not None:
                            n, top = seen.get(k, (0, LOW))
                            seen[k] = (n + 1, max(top, d))
                h1, h2 = _halves(seen)
                v = np.array(list(seen.values()), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in (h1.view(np.int64), h2.view(np.int64), v[:, 0], v[:, 1])], ["h1", "h2", "n", "top"])

    hashed = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "h1 long, h2 long, n long, top long")
    return hashed.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("top").alias("top")).filter(F.col("n") >= min_docs)


def _cut(text: bytes, gone):
    """(text without the lines of these numbers, how many lines it had)."""
    parts = text.split(b"\n")
    return b"\n".join(x for j, x in enumerate(parts) if j not in gone) if gone else text, len(parts)


RESULT = "struct<text:string,n_lines:long,n_dropped:long>"


def _result(texts, gone):
    import pyarrow as pa

    cut = [_cut(t, g) for t, g in zip(texts, gone)]
    return pa.StructArray.from_arrays([pa.array([x for x, _ in cut], pa.binary()).cast(pa.string()), pa.array([n for _, n in cut], pa.int64()), pa.array([len(g) for g in gone], pa.int64())], names=["text", "n_lines", "n_dropped"])


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, shard_keys: int = 50_000, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """docs(doc_id, text, ...) -> the same columns with text cut, and n_lines, n_dropped."""
    keys = materialise(repeated_lines(docs, min_chars, min_docs))
    n_shards = max(1, -(-keys.count() // shard_keys))
    sharded = keys.withColumn("shard", F.pmod("h1", F.lit(n_shards)))
    shards = materialise(sharded.groupBy("shard").applyInPandas(_build, "shard long, arrays binary"))
    size = shards.agg(F.coalesce(F.sum(F.length("arrays")), F.lit(0))).first()[0]
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    if size <= broadcast_bytes:
        done = docs.select(F.struct(*cols(docs, names)).alias("row"), _sent(docs.sparkSession, shards, n_shards, min_chars)("text", F.col("doc_id").cast("long")).alias("cut"))
    else:
        done = _dealt(docs.select(F.struct(*cols(docs, names)).alias("row"), F.col("doc_id").cast("long").alias("id"), "text"), shards, n_shards, min_chars)
    return done.select(*[F.col("cut.text").alias(c) if c.lower() == "text" else F.col(f"row.{quoted(c)}").alias(c) for c in names], "cut.n_lines", "cut.n_dropped")


_ARRAYS: dict = {}


def _sent(spark, shards, n_shards, min_chars):
    """All arrays, measured to be small, go to every task, which unpacks them once."""
    token = uuid.uuid4().hex
    bc = spark.sparkContext.broadcast({r[0]: bytes(r[1]) for r in shards.toLocalIterator()})

    def cut(texts, ids):
        import numpy as np

        if token not in _ARRAYS:
            _ARRAYS.clear()
            _ARRAYS[token] = {k: pickle.loads(v) for k, v in bc.value.items()}
        arrays = _ARRAYS[token]
        ids = [LOW if d is None else d for d in ids.to_pylist()]
        flat = [(i, j, k) for i, t in enumerate(texts) for j, k in enumerate(_keys(t, min_chars)) if k is not None]
        h1, h2 = _halves(k for _, _, k in flat)
        shard, drop = h1.view(np.int64) % n_shards, np.zeros(len(flat), bool)
        doc = np.array([ids[i] for i, _, _ in flat], dtype=np.int64)
        for s in np.unique(shard).tolist():
            if s in arrays:
                at = np.flatnonzero(shard == s)
                ok, top = probe(arrays[s], h1[at], h2[at])
                drop[at] = ok & (top != doc[at])
        gone = [set() for _ in texts]
        for (i, j, _), x in zip(flat, drop.tolist()):
            if x:
                gone[i].add(j)
        return _result(texts, gone)

    return text_udf(cut, RESULT, "doc_id")


def _dealt(rows, shards, n_shards, min_chars, per_task: int = 500_000):
    """Hashes of lines, once a slice of documents, meet the arrays by shard; what they find goes back to the slice.

    A line of every document is one probe a slice, and a shard with more than per_task probes is
    copied, so no line or shard makes a task of its own size.
    """

    def slice_ids(texts, ids):
        import pyarrow as pa

        return pa.array([uuid.uuid4().int >> 65] * len(texts), pa.int64())

    rows = materialise(rows.withColumn("slice", text_udf(slice_ids, "long", "id")("text", "id")))

    def hashes(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            token = b.column(0).to_numpy()
            by = {}
            for k, t in enumerate(b.column(1)):
                by.setdefault(int(token[k]), set()).update(x for x in _keys(t.as_buffer().to_pybytes() if t.is_valid else b"", min_chars) if x is not None)
            for s, ks in by.items():
                h1, h2 = _halves(ks)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h1), s)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], ["slice", "h1", "h2"])

    probes = materialise(rows.select("slice", "text").mapInArrow(hashes, "slice long, h1 long, h2 long"))
    copies = max(1, -(-probes.count() // (n_shards * per_task)))
    probes = probes.withColumns({"shard": F.pmod("h1", F.lit(n_shards)), "copy": F.pmod(F.xxhash64("slice"), F.lit(copies))})
    shards = shards.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))

    def find(left, right):
        import numpy as np
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"slice": [], "h1": [], "h2": [], "top": []}, dtype="int64")
        ok, top = probe(pickle.loads(right["arrays"].iloc[0]), left["h1"].to_numpy().view(np.uint64), left["h2"].to_numpy().view(np.uint64))
        return left[["slice", "h1", "h2"]].assign(top=top)[ok]

    hits = probes.groupBy("shard", "copy").cogroup(shards.groupBy("shard", "copy")).applyInPandas(find, "slice long, h1 long, h2 long, top long")

    def cut(left, right):
        import pyarrow as pa

        top = {a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True): t for a, b, t in zip(*(right.column(c).to_pylist() for c in ("h1", "h2", "top")))}
        texts = [t or b"" for t in left.column("text").cast(pa.binary()).to_pylist()]
        ids = [LOW if d is None else d for d in left.column("id").to_pylist()]
        gone = [{j for j, k in enumerate(_keys(t, min_chars)) if top.get(k, d) != d} for t, d in zip(texts, ids)]
        return pa.table({"row": left.column("row"), "cut": _result(texts, gone)})

    schema = StructType([rows.schema["row"], StructField("cut", StructType([StructField("text", StringType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())]))])
    return rows.groupBy("slice").cogroup(hits.groupBy("slice")).applyInArrow(cut, schema)
