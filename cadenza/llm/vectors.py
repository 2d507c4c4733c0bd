"""Embedding near-dedup by collision counting, and nearest neighbours by shifted Hilbert curves.

Defined results. Both: vectors that are null, empty, zero, or with null or non-finite components take
no part; vectors of different lengths never meet; other columns are left out, whatever their names.
Near-dedup: a vector without a part, or without a label, is alone; rows that repeat a vec_id are
vectors of their own, and all of them get the component_id of their own vector; a null vec_id takes
part, is never `kept`, and only a component without any other has component_id null. Vectors are
scaled by their largest component first, so any finite magnitude compares.
Neighbours: a row without a vec_id takes no part; rows that share the query's vec_id are its own; of
others that repeat a vec_id the nearest counts, once; equal distances go to the smaller vec_id.
"""
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import connected_components, materialise, union_min


def usable(e="embedding"):
    ok = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(e) > 0) & ok & F.exists(e, lambda x: x != 0), F.lit(False))


def _unit(x):
    x = x / np.abs(x).max(1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def _matrix(col):
    dim = len(col[0])
    return np.concatenate([np.asarray(v, float) for v in col]).reshape(-1, dim)


def _by_length(col: pa.Array):
    """(row numbers, matrix) for every length of vector in an Arrow list column."""
    size = np.array([len(x) for x in col])
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield at, col.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), n)


# -- near-dedup ---------------------------------------------------------------------------------


def calibrated(n_proj: int, inside: float, recall: float) -> int:
    """Largest count that a pair at the threshold reaches with probability recall."""
    import math

    tail, k = 0.0, n_proj + 1
    while tail < recall and k > 0:
        k -= 1
        tail += math.comb(n_proj, k) * inside**k * (1 - inside) ** (n_proj - k)
    return k


def directions(dim: int, n_proj: int, seed: int):
    r = np.random.default_rng(seed).normal(size=(dim, n_proj))
    return r / np.sqrt((r * r).sum(0))


#: Projections of unit vectors are counted in these units, as 16-bit integers.
UNITS = 8192


def prefix_sets(q):
    """(sorted values, prefix sets) of one projection: row r of the prefix sets holds, as bits, the vectors of the first r places."""
    order, words = np.argsort(q, kind="stable"), -(-len(q) // 64)
    one = np.zeros((len(q) + 1, words), np.uint64)
    one[np.arange(1, len(q) + 1), order >> 6] = np.uint64(1) << (order & 63).astype(np.uint64)
    return q[order].astype(np.int32), np.bitwise_or.accumulate(one, axis=0)


def count_windows(p, q, width: int, least: int, stretch: int = 256):
    """Yields (rows, columns) of pairs whose projections p[i], q[j] lie in each other's window at least `least` times.

    Every projection of q is sorted. The window centred on a query's own value is a run of places in
    that order, and the set of what it holds the difference of two prefix sets. The sets of all
    projections are added bit by bit: plane b of the counters holds bit b of all counts of a query.
    """
    n, planes = len(q), max(1, int(p.shape[1]).bit_length())
    sorts = [prefix_sets(q[:, t]) for t in range(p.shape[1])]
    spare = np.zeros((2, stretch, sorts[0][1].shape[1]), np.uint64)
    for a in range(0, len(p), stretch):
        block = p[a : a + stretch].astype(np.int32)
        count = np.zeros((planes, len(block), sorts[0][1].shape[1]), np.uint64)
        for t, (values, sets) in enumerate(sorts):
            lo = np.searchsorted(values, block[:, t] - width, "left")
            hi = np.searchsorted(values, block[:, t] + width, "right")
            carry = np.take(sets, hi, axis=0, out=spare[0][: len(block)])
            carry ^= np.take(sets, lo, axis=0, out=spare[1][: len(block)])
            for b in range((t + 1).bit_length()):
                up = np.bitwise_and(count[b], carry, out=spare[1 - b % 2][: len(block)])
                count[b] ^= carry
                carry = up
        more, same = np.zeros_like(count[0]), np.full_like(count[0], ~np.uint64(0))
        for b in range(planes - 1, -1, -1):  # counts against `least`, from the highest bit
            if least >> b & 1:
                same &= count[b]
            else:
                more |= same & count[b]
                same &= ~count[b]
        more |= same
        i, w = np.nonzero(more)
        bits = (more[i, w][:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        k, z = np.nonzero(bits)
        j = w[k] * 64 + z
        ok = j < n
        yield a + i[k][ok], j[ok]


def embedding_near_dedup(vecs: DataFrame, cosine: float = 0.93, n_proj: int = 32, block: int = 4096, sigmas: float = 2.0, recall: float = 0.99999, seed: int = 5) -> DataFrame:
    """vecs(vec_id, embedding, label) -> (vec_id, n_links, component_id, kept).

    Equal vectors of a label become one class first. Classes lie along a Hilbert curve of their first
    projections and are cut into blocks. For each block the range of every projection is known; two
    blocks meet only if enough of their ranges reach into each other's windows for a pair to pass. In
    a pair of blocks every projection is sorted, collisions in the window around each query are counted
    over all projections, and pairs with the calibrated count verified by cosine. A task returns link counts and a spanning forest, never pairs.
    """
    import math

    far = math.sqrt(2 - 2 * cosine)
    least = calibrated(n_proj, math.erf(sigmas / math.sqrt(2)), recall)
    width = lambda dim: sigmas * far / math.sqrt(dim) * UNITS + 2
    d = vecs.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"), (usable() & F.col("label").isNotNull()).alias("ok"))
    d = d.withColumns({"row_id": F.monotonically_increasing_id(), "k1": F.xxhash64("label", "v"), "k2": F.xxhash64(F.lit(1), "label", "v")})
    d = materialise(d)
    classes = d.filter("ok").groupBy("k1", "k2").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.min("row_id").alias("rep"), F.min("vec_id").alias("least_id"), F.count("*").alias("m"))

    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            p, key = np.zeros((len(b), n_proj), np.int16), np.zeros(len(b), np.int64)
            for at, x in _by_length(b):
                z = _unit(x) @ directions(x.shape[1], n_proj, seed)
                p[at] = np.round(z * UNITS)
                key[at] = hilbert_keys(np.clip(z[:, :4] * math.sqrt(x.shape[1]) * 16 + 64, 0, 127), 7)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), n_proj).cast(pa.list_(pa.int16()))
            yield pa.StructArray.from_arrays([flat, pa.array(key)], names=["p", "key"])

    placed = F.arrow_udf(place, "struct<p:array<short>,key:long>").asNondeterministic()
    c = materialise(classes.withColumn("at", placed("v")).select("k1", "k2", "label", F.size("v").alias("dim"), "v", "rep", "least_id", "m", "at.p", "at.key"))
    n = max(1, -(-c.count() // block))
    s = materialise(c.repartitionByRange(n, "label", "dim", "key", "rep").select("label", "dim", "v", "rep", "m", "p", F.spark_partition_id().alias("pid")))

    def bounds(batches):
        """Least and largest value of every projection, per label and length in this range."""
        held = {}
        for b in batches:
            p = b.column(3).flatten().to_numpy().reshape(-1, n_proj)
            for i, at in enumerate(zip(*(b.column(c).to_pylist() for c in range(3)))):
                lo, hi = held.get(at, (p[i], p[i]))
                held[at] = np.minimum(lo, p[i]), np.maximum(hi, p[i])
        yield pa.RecordBatch.from_pylist([dict(zip(("label", "dim", "pid", "lo", "hi"), (*at, lo.tolist(), hi.tolist()))) for at, (lo, hi) in held.items()],
                                         pa.schema([("label", kind), ("dim", pa.int32()), ("pid", pa.int32()), ("lo", pa.list_(pa.int16())), ("hi", pa.list_(pa.int16()))]))

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(s.schema["label"].dataType)
    ranges = s.select("label", "dim", "pid", "p").mapInArrow(bounds, f"label {s.schema['label'].dataType.simpleString()}, dim int, pid int, lo array<short>, hi array<short>")
    meta = materialise(ranges.groupBy("label", "dim", "pid").agg(F.collect_list(F.struct("lo", "hi")).alias("x")))
    most = lambda f, c: F.transform(F.sequence(F.lit(0), F.lit(n_proj - 1)), lambda t: f(F.transform("x", lambda x: x[c][t]))).alias(c)
    meta = meta.select("label", "dim", "pid", most(F.array_min, "lo"), most(F.array_max, "hi"))
    w = F.lit(sigmas * far * UNITS) / F.sqrt("dim") + 2
    meets = F.size(F.filter(F.arrays_zip("lo", "hi", "lo2", "hi2"), lambda x: (x["lo2"] - x["hi"] <= w) & (x["lo"] - x["hi2"] <= w)))
    other = meta.select("label", "dim", F.col("pid").alias("j"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    pairs = meta.withColumnRenamed("pid", "i").join(other, ["label", "dim"]).filter(F.col("i") <= F.col("j")).filter(meets >= least).select("label", "dim", "i", "j")
    sides = pairs.select("label", "dim", "i", "j", F.explode(F.when(F.col("i") == F.col("j"), F.array("i")).otherwise(F.array("i", "j"))).alias("pid"))

    def compare(pdf):
        import pandas as pd

        ids, m = pdf["rep"].to_numpy(), pdf["m"].to_numpy().astype(float)
        x, p = _unit(_matrix(pdf["v"].tolist())), np.stack(pdf["p"].to_numpy()).astype(np.int16)
        one = pdf["i"].iloc[0] == pdf["j"].iloc[0]
        rows = np.arange(len(x)) if one else np.flatnonzero((pdf["pid"] == pdf["i"]).to_numpy())
        other = rows if one else np.flatnonzero((pdf["pid"] == pdf["j"]).to_numpy())
        count, root, q = np.zeros(len(x)), np.arange(len(x)), p[other]
        for i, j in count_windows(p[rows], q, int(width(x.shape[1])), least):
            i, j = rows[i], other[j]
            if one:
                i, j = i[i < j], j[i < j]
            ok = np.concatenate([np.einsum("ij,ij->i", x[i[z : z + 65536]], x[j[z : z + 65536]]) >= cosine for z in range(0, max(1, len(i)), 65536)])
            i, j = i[ok], j[ok]
            count += np.bincount(i, weights=m[j], minlength=len(x)) + np.bincount(j, weights=m[i], minlength=len(x))
            root = union_min(len(x), np.concatenate([root, i]), np.concatenate([np.arange(len(x)), j]))
        keep = count > 0
        return pd.DataFrame({"rep": ids[keep], "n": count[keep].astype(np.int64), "root": ids[root[keep]]})

    linked = materialise(s.join(sides, ["label", "dim", "pid"]).groupBy("label", "dim", "i", "j").applyInPandas(compare, "rep long, n long, root long"))
    comp = connected_components(linked.select(F.col("rep").alias("a"), F.col("root").alias("b")).filter("a <> b").distinct())
    total = linked.groupBy("rep").agg(F.sum("n").alias("n"))
    by = c.select("k1", "k2", "rep", "least_id", "m").join(total, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    by = materialise(by.select("k1", "k2", "least_id", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("root")))
    least_of = materialise(by.groupBy("root").agg(F.min("least_id").alias("component_id")))
    by = materialise(by.join(least_of, "root").select("k1", "k2", "n_links", "component_id"))
    out = d.filter("ok").join(by, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = d.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


# -- nearest neighbours -------------------------------------------------------------------------


def hilbert_keys(q, bits: int):
    """Hilbert index of integer points (n, dims), by the transpose algorithm of Skilling (2004)."""
    x = q.astype(np.int64).T.copy()
    n, top = len(x), 1 << (bits - 1)
    m = top
    while m > 1:
        p = m - 1
        for i in range(n):
            t = np.where(x[i] & m, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(x[i] & m, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        m >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, m = np.zeros_like(x[0]), top
    while m > 1:
        t = np.where(x[n - 1] & m, t ^ (m - 1), t)
        m >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


class Curves:
    """Hilbert orders of vectors: per length of vector, principal axes of a bounded sample, mixed and shifted for each curve."""

    def __init__(self, sample, curves: int, dims: int, bits: int, seed: int):
        self.curves, self.dims, self.bits, self.seed, self.axes = curves, dims, bits, seed, {}
        for x in sample:
            top = np.abs(x).max()
            mean = (x / top).mean(0) * top
            _, _, v = np.linalg.svd((x - mean) / top, full_matrices=False)
            self.axes[x.shape[1]] = mean, v[:32].T, (x - mean) @ v[:32].T

    def keys(self, x, curve: int):
        rng = np.random.default_rng([self.seed, curve])
        n = x.shape[1]
        mean, axes, seen = self.axes.get(n, (np.zeros(n), np.eye(n)[:, :32], None))
        mix = np.linalg.qr(rng.normal(size=(axes.shape[1], min(self.dims, axes.shape[1]))))[0]
        shift = rng.uniform(0, 1, mix.shape[1])
        z = (x - mean) @ axes @ mix
        scale = (np.abs(z).max(0) / 3 if seen is None else (seen @ mix).std(0)) + 1e-300
        side = 1 << self.bits
        return hilbert_keys(np.nan_to_num(np.clip((z / scale / 8 + 0.5) * (side - 2) + shift, 0, side - 1)), self.bits)


def nearest(x, ids, y, own, k: int):
    """(rows of y, ids, distances) of the k nearest rows of x to each row of y, all but its own id; ties to the smaller id."""
    q, i, s = [], [], []
    nx, ny = (x * x).sum(1), (y * y).sum(1)
    for a in range(0, len(y), 256):
        rough = nx[None] - 2 * y[a : a + 256] @ x.T
        for j, r in enumerate(rough, a):
            at = np.flatnonzero(ids != own[j])
            if len(at) > k and np.isfinite(r[at]).all():
                cut = np.partition(r[at], k - 1)[k - 1]
                at = at[r[at] <= cut + 1e-9 * (ny[j] + nx.max())]
            with np.errstate(over="ignore"):
                dist = np.sqrt(((x[at] - y[j]) ** 2).sum(1))
            first = np.lexsort((ids[at], dist))
            first = first[np.sort(np.unique(ids[at][first], return_index=True)[1])[:k]]  # an id once
            q.append(np.full(len(first), j))
            i.append(ids[at[first]])
            s.append(dist[first])
    return tuple(np.concatenate(z) if z else np.zeros(0) for z in (q, i, s))


def exact_neighbours(base: DataFrame, asked: list, k: int) -> dict:
    """{query_id: ids of the k nearest} for a bounded list of (query_id, vector), by one pass over base(id, v)."""
    qid, ys = np.array([a for a, _ in asked]), [np.asarray(v, float) for _, v in asked]

    def scan(batches):
        best = {}
        for b in batches:
            ids = b.column(0).to_numpy()
            for at, x in _by_length(b.column(1)):
                mine = [j for j, y in enumerate(ys) if len(y) == x.shape[1]]
                if mine:
                    for j, i, s in zip(*nearest(x, ids[at], np.stack([ys[j] for j in mine]), qid[mine], k)):
                        best.setdefault(mine[int(j)], []).append((float(s), int(i)))
            best = {j: sorted(x)[: 2 * k] for j, x in best.items()}
        rows = [(int(qid[j]), i, s) for j, x in best.items() for s, i in x]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["query_id", "id", "score"])

    found = base.select("id", "v").mapInArrow(scan, "query_id long, id long, score double").groupBy("query_id", "id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "id"))
    out = {}
    for r in found.withColumn("rank", rank).filter(F.col("rank") <= k).collect():  # k rows a query
        out.setdefault(r.query_id, []).append(r.id)
    return out


def hilbert_neighbours(vecs: DataFrame, queries: DataFrame, k: int = 10, curves: int = 4, dims: int = 4, recall: float = 0.97, block: int = 1024, max_blocks: int = 16_384, least_rows: int = 4096,
                       sample: int = 4096, probes: int = 64, seed: int = 3, info: dict | None = None) -> DataFrame:
    """Nearest k of vecs(vec_id, embedding) for each of queries(vec_id, embedding), Euclidean.

    Each curve orders all projected, shifted vectors; the order is cut into at most max_blocks ranges of
    about `block` rows. A query's windows are the ranges up to h off its own place on every curve; what
    they hold merges and is ranked by exact distance. h is calibrated: for `probes` of the queries the
    true neighbours are found by one pass over all vectors, and h is the least that holds the share
    `recall` of them, but at least least_rows rows on both sides. So h is small where the curves keep
    neighbours together, and grows towards a scan where no order can, as with isotropic vectors.

    sample bounds the vectors that the axes are fitted on (4 million numbers at most). info, where given, gets h and the share of
    the vectors that the windows of a query hold.
    """
    base = vecs.filter(usable() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("v"))
    asked = materialise(queries.filter(usable() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").alias("q")))
    order = lambda c: (F.xxhash64(F.lit(seed), c), c)
    few = base.orderBy(*order("id")).limit(sample)
    dim = few.agg(F.max(F.size("v"))).first()[0]
    if dim is None:
        return asked.select("query_id", F.lit(0).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    seen: dict[int, list] = {}
    for r in few.limit(max(64, min(sample, 4_000_000 // dim))).collect():
        seen.setdefault(len(r.v), []).append(r.v)
    fitted = Curves([np.array(x, float) for x in seen.values()], curves, dims, 7, seed)

    def keyed(batches):
        for b in batches:
            for c in range(curves):
                key = np.zeros(b.num_rows, np.int64)
                for at, x in _by_length(b.column(1)):
                    key[at] = fitted.keys(x, c)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, c, np.int32)), pa.array([len(v) for v in b.column(1)], pa.int32()), pa.array(key), b.column(0), b.column(1)], ["curve", "dim", "key", "id", "v"])

    kind = dict(vecs.dtypes)["embedding"]
    schema = f"curve int, dim int, key long, id long, v {kind}"
    n_base = base.count()
    parts = max(2, min(max_blocks, -(-n_base // block)))
    laid = base.select("id", "v").mapInArrow(keyed, schema)
    laid = materialise(laid.repartitionByRange(parts * curves, "curve", "dim", "key", "id").withColumn("pid", F.spark_partition_id()))
    # the first place of every range, max_blocks a curve at most
    first = F.min(F.struct("curve", "dim", "key", "id")).alias("lo")
    ranges = sorted((tuple(r.lo), r.pid) for r in laid.groupBy("pid").agg(first).collect())
    places, pids = [r[0] for r in ranges], [r[1] for r in ranges]

    def place(batches):
        import bisect

        for b in keyed(batches):
            own = [pids[max(0, bisect.bisect_right(places, (c, n, key, i)) - 1)] for c, n, key, i in zip(*(b.column(x).to_pylist() for x in range(4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), b.column(4), pa.array(own, pa.int32())], ["curve", "dim", "query_id", "q", "own"])

    at = materialise(asked.select("query_id", "q").mapInArrow(place, f"curve int, dim int, query_id long, q {dict(queries.dtypes)['embedding']}, own int"))
    test = [(r.query_id, r.q) for r in asked.orderBy(*order("query_id")).limit(probes).collect()]
    truth = exact_neighbours(base, test, k)
    near = asked.sparkSession.createDataFrame([(q, i) for q, x in truth.items() for i in x], "query_id long, id long")  # probes * k rows at most
    off = laid.select("curve", "id", "pid").join(F.broadcast(near), "id").join(F.broadcast(at.select("curve", "query_id", "own").join(F.broadcast(near.select("query_id").distinct()), "query_id")), ["curve", "query_id"])
    off = sorted(r.off for r in off.groupBy("query_id", "id").agg(F.min(F.abs(F.col("pid") - F.col("own"))).alias("off")).collect())
    h = off[min(len(off) - 1, int(np.ceil(recall * len(off))))] if off else 0
    h = int(max(h, -(-least_rows // max(1, n_base // parts))))
    if info is not None:
        info |= {"h": h, "ranges": parts, "share_a_curve": min(1.0, (2 * h + 1) / parts)}
    # ranges of the query's own curve and length only
    there = laid.select("curve", "dim", "pid").distinct()
    visits = at.withColumn("pid", F.explode(F.sequence(F.col("own") - h, F.col("own") + h))).join(F.broadcast(there), ["curve", "dim", "pid"])
    # a range that more than 4,096 queries visit is read by several groups
    groups = visits.groupBy("curve", "pid").agg(F.ceil(F.count("*") / 4096).alias("n"))
    visits = visits.join(F.broadcast(groups), ["curve", "pid"]).withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("n")))
    held = laid.join(F.broadcast(groups), ["curve", "pid"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))

    def rank_range(left, right):
        import pandas as pd

        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for n in set(left["dim"]) & set(right["dim"]):
            c, q = left[left["dim"] == n], right[right["dim"] == n]
            own = q["query_id"].to_numpy()
            j, i, s = nearest(_matrix(c["v"].tolist()), c["id"].to_numpy(), _matrix(q["q"].tolist()), own, k)
            out.append((own[j.astype(int)], i.astype(np.int64), s))
        return pd.DataFrame({name: np.concatenate(z) for name, z in zip(("query_id", "vec_id", "score"), zip(*out))})

    found = held.select("curve", "pid", "part", "dim", "id", "v").groupBy("curve", "pid", "part").cogroup(visits.select("curve", "pid", "part", "dim", "query_id", "q").groupBy("curve", "pid", "part"))
    merged = found.applyInPandas(rank_range, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return merged.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
