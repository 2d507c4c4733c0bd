"""Helpers shared by the training-data operators."""
import contextlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import shared_dir

SPACE = r"[\x20\x09-\x0D]"
_OPEN: list[list] = []


def quoted(name: str) -> str:
    """A column name as it stands in a path: dots, spaces and backticks are part of it."""
    return "`" + name.replace("`", "``") + "`"


def cols(df: DataFrame, names=None) -> list:
    return [F.col(quoted(c)) for c in (df.columns if names is None else names)]


def materialise(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cadenza-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored = path
    if _OPEN:
        _OPEN[-1].append(out)
    return out


def drop(*frames: DataFrame) -> None:
    """Delete what materialise() stored for these frames; nothing that reads them may run later."""
    for x in frames:
        if path := getattr(x, "_stored", None):
            jvm, sc = x.sparkSession._jvm, x.sparkSession.sparkContext
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
            x._stored = None


@contextlib.contextmanager
def scratch(*kept: DataFrame):
    """Deletes, at its end, what was stored inside, but for frames given to the function it yields."""
    _OPEN.append([])
    keep = set()
    try:
        yield lambda x: keep.add(id(x)) or x
    finally:
        drop(*[x for x in _OPEN.pop() if id(x) not in keep])


def bounded_batches(spark: SparkSession, most: str = "4m") -> None:
    """For programs, such as the queries and the pipeline: bounds the bytes of an Arrow batch in this session.

    Operators leave the session as it is; they work at any bound, in slices of their own.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def slices(text: pa.Array, most: int = 2 << 20, rows: int = 2000) -> Iterator[tuple[int, int]]:
    """(start, length) of stretches of a string array of at most `most` bytes and `rows` rows; a longer text stands alone."""
    import numpy as np

    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(text):
        before = ends[at - 1] if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + most, "right"))), len(text))
        yield at, end - at
        at = end


def text_udf(f, returns: str, *more):
    """An Arrow UDF of a text column (and others) that calls f on slices of bounded bytes.

    f takes a list of UTF-8 bytes (null: empty) and the other columns' slices, and gives an Arrow
    array. Only these columns reach Python; all others of a row stay in the JVM.
    Non-deterministic to the optimizer, so that it is never evaluated twice.
    """

    def call(text, others):
        out = []
        for at, n in slices(text):
            part = [t or b"" for t in text.slice(at, n).cast(pa.binary()).to_pylist()]
            out.append(f(part, *[o.slice(at, n) for o in others]))
        return pa.concat_arrays(out) if out else f([], *others)

    if more:

        def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for text, *others in batches:
                yield call(text, others)

    else:

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for text in batches:
                yield call(text, [])

    return F.arrow_udf(run, returns).asNondeterministic()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b) of longs -> (node, component): the smallest node reachable.

    Contraction: every root hooks to its smallest neighbour, parents jump twice, edges
    are rewritten to roots. Each round stores its (shrinking) edges and deletes those of the last.
    Both sides of every join are plain reads, so that Spark can split a hub's partition.
    """
    both = edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select("b", "a")).toDF("a", "b")
    e = materialise(both.distinct())
    comp = materialise(e.select(F.col("a").alias("node")).distinct().withColumn("c", F.col("node")))
    while not e.isEmpty():
        p = e.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p"))
        p = materialise(p)
        for _ in range(2):
            q = p.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            last, p = p, materialise(p.join(q, "p").select("a", F.col("pp").alias("p")))
            drop(last)
        up = p.select(F.col("a").alias("c"), "p")
        last, comp = comp, materialise(comp.join(up, "c", "left").select("node", F.coalesce("p", "c").alias("c")))
        drop(last)
        ea = e.join(p, "a").select(F.col("p").alias("a"), "b")
        eb = ea.join(p.select(F.col("a").alias("b"), F.col("p").alias("q")), "b").select("a", F.col("q").alias("b"))
        last, e = e, materialise(eb.filter("a <> b").distinct())
        drop(last, p)
    drop(e)
    return comp.select("node", F.col("c").alias("component"))


def union_min(n: int, i, j):
    """Local components of n items linked by index arrays i, j: smallest index of each."""
    import numpy as np

    lab = np.arange(n)
    while len(i):
        before = lab.copy()
        low = np.minimum(lab[i], lab[j])
        np.minimum.at(lab, i, low)
        np.minimum.at(lab, j, low)
        lab = lab[lab]
        if (lab == before).all():
            break
    return lab
