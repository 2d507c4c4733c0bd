"""SimHash near-dedup by Golay-code fuzzy hashing.

64 bits are cut into three segments (22, 21, 21 bits), each padded to a word of the perfect
[23,12,7] Golay code. A segment's keys are the codewords that it or a word one bit away decodes
to: six at most, and words two bits apart share one. Four errors over three segments leave two
segments with at most two together, so pairs of segments' keys find every link; each is verified.

Defined results: null text has no words (fingerprint zero); rows are linked by their fingerprints
alone, so rows that only share a doc_id stay apart; rows with a null doc_id take part like any other,
and a component without a doc_id has component_id null; repeated rows are rows of the result; an empty table
gives no rows; a text of any length is read whole, in one task's memory; other columns may have any name.
"""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cols, connected_components, materialise, text_udf, union_min

#: Fixed value: generator polynomial of the binary Golay code.
GENERATOR = 0b101011100011
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def syndromes(words):
    """Remainder of 23-bit words modulo the generator."""
    import numpy as np

    r = words.copy()
    for bit in range(22, 10, -1):
        r = np.where((r >> bit) & 1 == 1, r ^ (GENERATOR << (bit - 11)), r)
    return r


def golay_tables():
    """leader[s]: the error of syndrome s; offsets[s]: errors that lead to the nearby codewords."""
    import itertools

    import numpy as np

    leader = np.zeros(2048, np.int64)
    for w in range(1, 4):
        errors = np.array([sum(1 << i for i in c) for c in itertools.combinations(range(23), w)], dtype=np.int64)
        leader[syndromes(errors)] = errors
    s, one = np.arange(2048), 1 << np.arange(23)
    near = np.concatenate([leader[s][:, None], one[None] ^ leader[s[:, None] ^ syndromes(one)[None]]], axis=1)
    offsets = [np.unique(x) for x in near]
    out = np.full((2048, max(map(len, offsets))), -1, np.int64)
    for i, x in enumerate(offsets):
        out[i, : len(x)] = x
    return leader, out


def segment_keys(words, offsets):
    """(n, 6) codeword indices of 23-bit words; -1 where a word has fewer."""
    import numpy as np

    e = offsets[syndromes(words)]
    return np.where(e >= 0, (words[:, None] ^ e) >> 11, -1)


def majority(text: bytes, words: int) -> int:
    """Majority bits of XXH64 of all word shingles of a text; 0 without words."""
    import numpy as np
    import xxhash

    h, w = xxhash.xxh64_intdigest, text.lower().split()
    if not w:
        return 0
    votes, shingles = np.zeros(64, np.int64), max(1, len(w) - words + 1)
    for k in range(0, shingles, 100_000):
        part = w[k : min(k + 100_000, shingles) + words - 1]
        if len(part) <= words:
            hs = [h(b" ".join(part), 42)]
        else:
            size = np.fromiter(map(len, part), np.int64, len(part))
            end = np.cumsum(size + 1) - 1
            joined, start = b" ".join(part), (end - size).tolist()
            hs = [h(joined[a:z], 42) for a, z in zip(start, end[words - 1 :].tolist())]
        bits = np.unpackbits(np.array(hs, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for j in range(0, len(bits), 255):
            votes += bits[j : j + 255].sum(0, dtype=np.uint8)
    return int(np.packbits(votes * 2 > shingles, bitorder="little").view("<u8")[0])


def fingerprint(text="text", words: int = 4):
    """Column long: the fingerprint of a text column; only the text goes to Python."""

    def run(texts):
        import numpy as np
        import pyarrow as pa

        return pa.array(np.array([majority(t, words) for t in texts], dtype=np.uint64).view(np.int64))

    return text_udf(run, "long")(text)


def fuzzy_keys(fps: DataFrame) -> DataFrame:
    """fps(fp) -> (key, fp): all pairs of two segments' codeword indices."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        offsets = golay_tables()[1]
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            seg = [segment_keys(((fp >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64), offsets) for s, n in SEGMENTS]
            for k, (x, y) in enumerate(((0, 1), (0, 2), (1, 2))):
                key = (k << 24) | (seg[x][:, :, None] << 12) | seg[y][:, None, :]
                ok = (seg[x][:, :, None] >= 0) & (seg[y][:, None, :] >= 0)
                row = np.broadcast_to(np.arange(len(fp))[:, None, None], ok.shape)[ok]
                yield pa.RecordBatch.from_arrays([pa.array(key[ok].astype(np.int32)), pa.array(fp[row].view(np.int64))], ["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key int, fp long")


def _links(key, fp, bits, lower=None):
    """Spanning forest, as (smaller, larger) fingerprints, of the links within each key's run.

    key, fp: sorted by key. lower: where given, only pairs of a row under it and one from it on count.
    """
    import numpy as np

    uf, node = np.unique(fp, return_inverse=True)
    order = np.arange(len(key)) if lower is not None else np.lexsort((fp, key))
    key, node = key[order], node[order]
    u = uf[node].view(np.uint64)
    lab, ii, jj = np.arange(len(uf)), [], []

    def fold():
        nonlocal lab, ii, jj
        lab = union_min(len(uf), np.concatenate([lab, *ii]), np.concatenate([np.arange(len(uf)), *jj]))
        ii, jj = [], []

    if lower is not None:
        for k in range(lower):
            near = np.flatnonzero(np.bitwise_count(u[k] ^ u[lower:]) <= bits)
            ii.append(np.full(len(near), node[k]))
            jj.append(node[lower + near])
            if k % 256 == 255:
                fold()
    else:
        shift, at = 1, np.arange(len(key))
        while len(at):
            at = at[at + shift < len(key)]
            at = at[key[at] == key[at + shift]]
            near = np.bitwise_count(u[at] ^ u[at + shift]) <= bits
            ii.append(node[at[near]])
            jj.append(node[at[near] + shift])
            shift += 1
            if sum(map(len, ii)) > 2_000_000:
                fold()
    fold()
    m = lab != np.arange(len(uf))
    return uf[lab[m]], uf[m]


def verified(keys: DataFrame, bits: int, block: int = 8192) -> DataFrame:
    """Links a < b within keys' buckets, thinned to a spanning forest per stretch of sorted keys.

    Buckets are read in sorted order. One with more than `block` fingerprints is not compared where it
    was read: it leaves the task in blocks, and every pair of its blocks is a task's group of its own,
    so neither a task's memory nor its work grows with a bucket.
    """
    import numpy as np

    def run(batches):
        import pyarrow as pa

        out = lambda kind, a, b, i: pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b), pa.array(np.full(len(a), i, np.int32))], ["kind", "a", "b", "block"])
        key, fp, large, done = np.zeros(0, np.int32), np.zeros(0, np.int64), None, 0

        def close():
            """The bucket that left in blocks has ended: how many there were."""
            nonlocal large, done
            if large is not None:
                yield out(2, np.array([int(large)]), np.array([0]), done)
            large, done = None, 0

        def part(key, fp, ended):
            """Whole buckets are compared; of the last one blocks leave while it goes on. Returns what waits."""
            nonlocal large, done
            last = key[-1]
            cut = len(key) if ended else int(np.searchsorted(key, last))
            starts = np.flatnonzero(np.concatenate([[True], key[1:cut] != key[: cut - 1]])) if cut else np.zeros(0, int)
            sizes = np.diff(np.append(starts, cut))
            small = np.ones(cut, bool)
            for s, n in zip(starts.tolist(), sizes.tolist()):
                if n > block or key[s] == large:
                    small[s : s + n] = False
                    if key[s] != large:
                        yield from close()
                        large = key[s]
                    for k in range(s, s + n, block):
                        x = fp[k : min(k + block, s + n)]
                        yield out(1, np.full(len(x), int(large)), x, done)
                        done += 1
                    yield from close()
            if small.any():
                a, b = _links(key[:cut][small], fp[:cut][small], bits)
                yield out(0, a, b, 0)
            key, fp = key[cut:], fp[cut:]
            while len(key) > 2 * block:
                if large != last:
                    yield from close()
                    large = last
                yield out(1, np.full(block, int(last)), fp[:block], done)
                done += 1
                key, fp = key[block:], fp[block:]
            waits.append((key, fp))

        waits = []
        for b in batches:
            key, fp = np.concatenate([key, b.column(0).to_numpy()]), np.concatenate([fp, b.column(1).to_numpy()])
            if len(key) > 200_000:
                yield from part(key, fp, False)
                key, fp = waits.pop()
        if len(key):
            yield from part(key, fp, True)
        yield from close()

    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = materialise(keys.repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, "kind int, a long, b long, block int"))
    links = found.filter("kind = 0").select("a", "b")
    if found.filter("kind = 2").isEmpty():
        return links
    blocks = found.filter("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"), "block")
    sides = found.filter("kind = 2").select(F.col("a").alias("key"), F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("i"), F.col("block").alias("n"))
    sides = sides.select("key", "i", F.explode(F.sequence(F.col("i"), F.col("n") - 1)).alias("j"))
    sides = sides.select("key", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))

    def pair(pdf):
        import pandas as pd

        pdf = pdf.sort_values("block", kind="stable")
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        lower = int((pdf["block"] == i).sum()) if i < j else None
        a, b = _links(np.zeros(len(pdf), np.int32), pdf["fp"].to_numpy(), bits, lower)
        return pd.DataFrame({"a": a, "b": b})

    return links.union(blocks.join(sides, ["key", "block"]).groupBy("key", "i", "j").applyInPandas(pair, "a long, b long"))


def components(fp: DataFrame, first, bits: int) -> DataFrame:
    """fp(fp, ...) -> (fp, first, root): the aggregate `first` of each fingerprint, and its component. Stored."""
    classes = materialise(fp.groupBy("fp").agg(first.alias("first")))
    comp = connected_components(verified(fuzzy_keys(classes), bits).distinct())
    return materialise(classes.join(comp, classes.fp == comp.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("root")))


def simhash_near_dedup(docs: DataFrame, bits: int = 4, words: int = 4) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, fp, component_id), one row per row of docs.

    Both sides of the joins on a component and on a fingerprint are plain reads, so that Spark can
    split the partition of a component, or of a text, that holds much of all rows.
    """
    fp = materialise(docs.select(F.col("doc_id").cast("long"), fingerprint(words=words).alias("fp")))
    roots = components(fp, F.min("doc_id"), bits)
    least = materialise(roots.groupBy("root").agg(F.min("first").alias("component_id")))
    by_fp = materialise(roots.join(least, "root").select("fp", "component_id"))
    return fp.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def one_per_component(docs: DataFrame, bits: int = 4, words: int = 4) -> DataFrame:
    """docs(doc_id, text, ...) -> the same columns, exactly one row of each component.

    It is the row of the smallest doc_id, null being the largest; among rows of that doc_id the one
    with the least hash of its columns. The row number only parts equal rows; it is stored with
    them, so that it holds.
    """
    own = [f"cadenza:{x}" for x in ("fp", "hash", "row")]
    rows = docs.withColumns({own[0]: fingerprint(words=words), own[1]: F.xxhash64(*[c.cast("string") if "map<" in t else c for c, (_, t) in zip(cols(docs), docs.dtypes)]), own[2]: F.monotonically_increasing_id()})
    rows = materialise(rows)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col(own[1]).alias("row_hash"), F.col(own[2]).alias("row_id"))
    classes = rows.select(F.col(own[0]).alias("fp"), rank.alias("rank"))
    kept = components(classes, F.min("rank"), bits).groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row_id").alias(own[2]))
    # a merge join at every size, so that shuffle grows in proportion to the input
    return rows.join(materialise(kept).hint("merge"), own[2], "left_semi").drop(*own)
