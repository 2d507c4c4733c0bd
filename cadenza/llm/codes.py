"""Vector code compression: a codebook for each part of a vector, entries found through broadcast kd-trees.

Components become integers floor(1024 x). Every round broadcasts a kd-tree of each codebook; tasks look
for the nearest entry of every part by branch and bound and send on integer sums a part and entry, which
Spark adds up; an entry becomes the floor of its mean. Nothing but codebooks comes to the driver: parts x
entries x part length integers.

Defined results: rows with a null vector, with null or non-finite components, or with a length other than
that of the smallest vec_id's vector are dropped, as are all where that length does not divide into the
parts; vec_ids that repeat are rows of their own, in order of components where codebooks begin, null
vec_ids last; fewer rows than entries make fewer entries; an empty table gives no rows; equal distances go
to the lower entry; components beyond 2^27 / 1024 are refused, as their errors are no longs. A hot or null
label is one sum. Columns of the same names as results do not stay.
"""
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

SCALE, LEAF, ROWS = 1024, 16, 4096


def kd_tree(book: np.ndarray):
    """Nodes of a codebook in depth-first order: (low, high, left, right, indexes), children -1 and ascending indexes in a leaf."""
    nodes = []

    def grow(idx):
        at, box = len(nodes), book[idx]
        low, high = box.min(0), box.max(0)
        nodes.append(None)
        if len(idx) <= LEAF or (low == high).all():
            nodes[at] = low, high, -1, -1, np.sort(idx)
            return at
        axis = int(np.argmax(high - low))
        order = idx[np.argsort(box[:, axis], kind="stable")]
        half = len(order) // 2
        left, right = grow(order[:half]), grow(order[half:])
        nodes[at] = low, high, left, right, None
        return at

    if len(book):
        grow(np.arange(len(book)))
    return nodes


def search(nodes, book, q):
    """(index, squared distance) of the nearest entry of each row of q; of equal ones the lowest.

    First every row goes down to one leaf, whose nearest entry bounds what is left; then each node is
    opened for the rows whose distance to its box is at most their bound. A box as far as the bound is
    opened too, as it may hold an equal entry of lower index.
    """
    exact = np.float64 if max(np.abs(q).max(initial=0), np.abs(book).max(initial=0)) <= 1 << 20 and q.shape[1] <= 1024 else np.int64
    q, book = q.astype(exact), book.astype(exact)  # all sums stay below 2^53, or 2^63
    own, sizes = (q * q).sum(1), (book * book).sum(1)
    best, at = np.full(len(q), np.iinfo(np.int64).max, exact), np.full(len(q), len(book))

    def look(rows, idx):
        d = own[rows, None] - 2 * (q[rows] @ book[idx].T) + sizes[idx]
        k = d.argmin(1)
        d, i = d[np.arange(len(rows)), k], idx[k]
        better = (d < best[rows]) | (d == best[rows]) & (i < at[rows])
        best[rows[better]], at[rows[better]] = d[better], i[better]

    def apart(node, rows):
        gap = np.maximum(np.maximum(nodes[node][0] - q[rows], q[rows] - nodes[node][1]), 0)
        return (gap * gap).sum(1)

    todo, seen = [(0, np.arange(len(q)))], {}
    while todo:
        node, rows = todo.pop()
        _, _, left, right, idx = nodes[node]
        if idx is not None:
            look(rows, idx)
            seen[node] = rows
        else:
            near = apart(left, rows) <= apart(right, rows)
            todo += [(n, r) for n, r in ((left, rows[near]), (right, rows[~near])) if len(r)]
    todo = [(0, np.arange(len(q)))]
    while todo:
        node, rows = todo.pop()
        _, _, left, right, idx = nodes[node]
        rows = rows[apart(node, rows) <= best[rows]]
        if not len(rows):
            continue
        if idx is None:
            todo += [(right, rows), (left, rows)]
        else:
            done = np.zeros(len(q), bool)
            done[seen.get(node, [])] = True
            if len(rows := rows[~done[rows]]):
                look(rows, idx)
    return at, best.astype(np.int64)


def integers(vectors: pa.Array) -> np.ndarray:
    """A list array of finite floats of one length -> (rows, length) of floor(1024 x)."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if np.abs(flat).max(initial=0) * SCALE > 1 << 27:
        raise ValueError("components beyond 2^27 / 1024 cannot be coded in longs")
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(vectors), -1)


def _nearest(vectors, books, trees):
    """Slices of a list array: (integers, entries by part, distances by part)."""
    parts, width = len(books), books[0].shape[1]
    for at in range(0, len(vectors), ROWS):
        x = integers(vectors.slice(at, ROWS)).reshape(-1, parts, width)
        found = [search(trees[p], books[p], x[:, p]) for p in range(parts)]
        yield x, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _sums(shared):
    """Vectors -> (part, entry, n, sums) of a task: at most parts x entries rows."""

    def run(batches):
        books, trees = shared.value
        n = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for x, at, _ in _nearest(batch.column(0), books, trees):
                for p in range(len(books)):
                    order = np.argsort(at[:, p], kind="stable")
                    entries, first = np.unique(at[order, p], return_index=True)
                    sums[p][entries] += np.add.reduceat(x[order, p], first, axis=0)
                    n[p] += np.bincount(at[:, p], minlength=len(n[p]))
        rows = [(p, int(e), int(n[p][e]), sums[p][e].tolist()) for p in range(len(books)) for e in np.flatnonzero(n[p])]
        part, entry, count, total = zip(*rows) if rows else ((),) * 4
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count, pa.int64()), pa.array(total, pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    return run


def codable(vectors: DataFrame, parts: int = 4) -> tuple[DataFrame, int]:
    """(rows that can be coded, length of a part); see the module for those that cannot."""
    fine = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    x = vectors.filter(F.col("embedding").isNotNull() & ~F.coalesce(fine, F.lit(True)))
    first = x.orderBy(F.asc_nulls_last("vec_id"), "embedding").select(F.size("embedding").alias("d")).first()
    size = first.d if first and first.d and first.d % parts == 0 else 0
    return x.filter((F.size("embedding") == size) & F.lit(size > 0)), size // parts


def train_codebooks(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> list[np.ndarray]:
    """Codebooks (entries, part length), one a part, from rows that codable() gave."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "embedding").select("embedding").limit(entries).collect()  # `entries` vectors
    if not first:
        return []
    x = integers(pa.array([r.embedding for r in first], pa.list_(pa.float64()))).reshape(len(first), parts, -1)
    books, sc = [np.ascontiguousarray(x[:, p]) for p in range(parts)], vectors.sparkSession.sparkContext
    for _ in range(rounds):
        shared = sc.broadcast((books, [kd_tree(b) for b in books]))
        part = vectors.select("embedding").mapInArrow(_sums(shared), "part int, entry int, n long, sums array<long>")
        total = part.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(x.shape[2])]).alias("sums"))
        for r in total.collect():  # one row an entry
            books[r.part][r.entry] = [s // r.n for s in r.sums]
        shared.unpersist()
    return books


def codebooks_text(books) -> str:
    """All components in order of part, entry and position."""
    return ",".join(str(v) for b in books for v in b.ravel().tolist())


def encode(vectors: DataFrame, books) -> DataFrame:
    """Rows that codable() gave -> vec_id, label, code (two hex digits a part), error."""
    if not books:
        return vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    shared = vectors.sparkSession.sparkContext.broadcast((books, [kd_tree(b) for b in books]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for v in batches:
            code, error = [], [np.zeros(0, np.int64)]
            for _, at, far in _nearest(v, *shared.value):
                code += [r.tobytes().hex() for r in at.astype(np.uint8)]
                error.append(far.sum(1))
            yield pa.StructArray.from_arrays([pa.array(code, pa.string()), pa.array(np.concatenate(error), pa.int64())], ["code", "error"])

    made = F.arrow_udf(run, "struct<code:string,error:long>").asNondeterministic()
    return vectors.select("vec_id", "label", made("embedding").alias("x")).select("vec_id", "label", "x.code", "x.error")


def decode(codes: DataFrame, books) -> DataFrame:
    """(vec_id, code) -> (vec_id, embedding): each part's entry divided by 1024; the books go along in the plan."""
    part = lambda p, b: F.array(*[F.array(*[F.lit(v / SCALE) for v in e]) for e in b.tolist()])[F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")]
    return codes.select("vec_id", F.concat(*[part(p, b) for p, b in enumerate(books)]).alias("embedding"))


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """vectors(vec_id, embedding, label) -> (vec_id, code, error, label_error, codebooks_sha256)."""
    x, width = codable(vectors, parts)
    books = train_codebooks(x, parts, entries, rounds) if width else []
    coded = materialise(encode(x, books))
    total = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return coded.join(total, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def codes_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """The same in DuckDB SQL: squared distances from products, exact in doubles at this size."""
    near = "SELECT q.vec_id, q.part, q.x, arg_min(b.entry, (list_dot_product(q.x, q.x) - 2 * list_dot_product(q.x, b.c) + list_dot_product(b.c, b.c)) * 512 + b.entry) AS entry, min(list_dot_product(q.x, q.x) - 2 * list_dot_product(q.x, b.c) + list_dot_product(b.c, b.c)) AS far FROM q JOIN {b} b ON q.part = b.part GROUP BY ALL"
    steps = []
    for k in range(rounds):
        steps.append(f"a{k} AS MATERIALIZED ({near.format(b=f'b{k}')})")
        steps.append(f"m{k} AS (SELECT part, entry, list(m ORDER BY pos) AS c FROM (SELECT part, entry, pos, floor(CAST(sum(v) AS DOUBLE) / count(*)) AS m FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM a{k}) GROUP BY ALL) GROUP BY ALL)")
        steps.append(f"b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN m{k} m USING (part, entry))")
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS MATERIALIZED (SELECT vec_id, part, list_slice(e, part * (len(e) // {parts}) + 1, (part + 1) * (len(e) // {parts})) AS x FROM (SELECT vec_id, e, unnest(range({parts})) AS part FROM v)),
b0 AS MATERIALIZED (SELECT part, rank - 1 AS entry, x AS c FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS rank FROM q) WHERE rank <= {entries}),
{", ".join(steps)},
f AS MATERIALIZED ({near.format(b=f'b{rounds}')}),
c AS (SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM f GROUP BY vec_id),
s AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM (SELECT part, entry, unnest(c) AS x, generate_subscripts(c, 1) AS pos FROM b{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c JOIN v USING (vec_id) CROSS JOIN s"""
