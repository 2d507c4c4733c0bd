"""Source divergence audit: how far the term shares of a language's sources lie apart.

Texts become counts of (lang, source, term) slice by slice in DuckDB, which Spark sums. These rows are
dealt to shards by a hash of lang and term; in a shard DuckDB keeps the terms of enough documents, and,
once Spark has summed what a group holds of them, adds up the terms' part of every pair of sources and
ranks the shard's terms. Spark merges the sums and the ranks.

Defined results: null text, lang and source count as ''; every row is a document, repeated rows and
doc_ids too; an empty table has no rows, a table without kept terms pairs of value 0 and no term; a text
of any length is cut into slices of bounded bytes between its terms, so it is never held twice as terms;
ties go to the smaller item in UTF-8 order; other columns of docs are not read.
"""
import functools
import math

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, slices

#: A-Z to a-z, all other ASCII but a-z to a space; what is left between spaces is a term.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SCALE = 1_000_000_000


@functools.cache
def duck():
    """DuckDB in one thread, without files of its own; one for each Python worker."""
    import duckdb

    return duckdb.connect(config={"threads": 1, "temp_directory": "", "memory_limit": "1GB"})


def pieces(text: bytes, most: int = 4 << 20):
    """Stretches of a text of about `most` bytes that end at a space; a longer word stands alone."""
    at = 0
    while len(text) - at > most:
        cut = text.rfind(b" ", at, at + most)
        cut = text.find(b" ", at + most) if cut <= at else cut
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


_COUNTED = """
INSERT INTO held SELECT lang, source, term, CAST(sum(n) AS BIGINT), count(*) FROM (
 SELECT row, lang, source, term, count(*) AS n FROM (SELECT row, lang, source, unnest(string_split(words, ' ')) AS term FROM t) WHERE term <> '' GROUP BY ALL) GROUP BY ALL"""
_ADDED = "CREATE OR REPLACE TABLE held AS SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n, CAST(sum(docs) AS BIGINT) AS docs FROM held GROUP BY ALL"


def _term_counts(batches, most: int = 1_000_000):
    """(text, lang, source) -> (lang, source, term, n, docs), summed over a task as far as `most` rows allow; a null term counts a group's documents."""
    con = duck()
    con.execute("CREATE OR REPLACE TABLE held (lang VARCHAR, source VARCHAR, term VARCHAR, n BIGINT, docs BIGINT)")

    def emit():
        out = con.sql("SELECT * FROM held").to_arrow_table()
        con.execute("DELETE FROM held")
        yield from out.to_batches(max_chunksize=50_000)

    for batch in batches:
        text, lang, source = batch.columns
        for at, k in slices(text):
            rows = [(x or b"").translate(LETTERS) for x in text.slice(at, k).cast(pa.binary()).to_pylist()]
            name = lambda c: pc.fill_null(c.slice(at, k), "")  # noqa: B023, E731
            t = pa.table({"row": pa.array(range(k), pa.int32()), "lang": name(lang), "source": name(source)})  # noqa: F841
            con.register("t", t)
            con.execute("INSERT INTO held SELECT lang, source, NULL, 0, count(*) FROM t GROUP BY ALL")
            if k == 1 and len(rows[0]) > 4 << 20:  # a long text alone: the parts' terms are those of one document
                total = {}
                for part in pieces(rows[0]):
                    for w in part.split():
                        total[w] = total.get(w, 0) + 1
                con.register("long_terms", pa.table({"term": pa.array(list(total), pa.binary()).cast(pa.string()), "n": pa.array(list(total.values()), pa.int64())}))
                con.execute("INSERT INTO held SELECT lang, source, term, n, 1 FROM t CROSS JOIN long_terms")
            else:
                con.register("t", t.append_column("words", pa.array(rows, pa.binary()).cast(pa.string())))
                con.execute(_COUNTED)
            if con.sql("SELECT count(*) FROM held").fetchall()[0][0] > most:
                con.execute(_ADDED)
                if con.sql("SELECT count(*) FROM held").fetchall()[0][0] > most // 2:
                    yield from emit()
    con.execute(_ADDED)
    yield from emit()


COUNTS = "lang string, source string, term string, n long, docs long"


def term_counts(docs: DataFrame) -> DataFrame:
    """docs(text, lang, source) -> (lang, source, term, n, docs), with a row of null term for each (lang, source)."""
    part = docs.select(*[F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")]).mapInArrow(_term_counts, COUNTS)
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _kept_terms(least: int):
    def run(t: pa.Table) -> pa.Table:
        con = duck()
        con.register("t", t)
        return con.sql(f"SELECT any_value(shard) AS shard, lang, term, list(source ORDER BY source) AS sources, list(n ORDER BY source) AS ns FROM t GROUP BY lang, term HAVING sum(docs) >= {least}").to_arrow_table()

    return run


#: p of every group of a language for a stretch of terms, q of the language, then sums and ranks.
_SHARES = f"""
CREATE OR REPLACE TEMP TABLE d AS
SELECT w.id, g.source, coalesce(u.n, 0) AS n, CAST(1 + (CAST({SCALE} AS HUGEINT) * (coalesce(u.n, 0) + 1)) // (g.total + g.v) AS BIGINT) AS p
FROM w JOIN g ON w.lang = g.lang LEFT JOIN u ON u.id = w.id AND u.source = g.source"""
_PAIRS = """
INSERT INTO pairs SELECT {lang}, x.source, y.source, sum((x.p - y.p) * (x.p - y.p) // y.p), sum((x.p - y.p) * (x.p - y.p) // x.p)
FROM d x JOIN d y ON x.id = y.id AND x.source < y.source GROUP BY x.source, y.source"""
_TOP = f"""
INSERT INTO tops WITH q AS (SELECT w.id, w.term, CAST(1 + (CAST({SCALE} AS HUGEINT) * (list_sum(w.ns) + 1)) // (l.total + l.v) AS BIGINT) AS q FROM w JOIN l ON w.lang = l.lang),
f AS (SELECT d.source, q.term, (d.p - q.q) * (d.p - q.q) // q.q AS value FROM d JOIN q ON d.id = q.id WHERE d.n > 0 AND d.p > q.q)
SELECT {{lang}}, source, term, value FROM f QUALIFY row_number() OVER (PARTITION BY source ORDER BY value DESC, term) <= {{top}}"""


def _shard_sums(top: int, most: int = 1_000_000):
    """One shard: (lang, source, item, value, is_pair); terms are taken in stretches of at most `most` shares."""
    ddl = "(lang VARCHAR, source VARCHAR, item VARCHAR, value HUGEINT"

    def run(kept: pa.Table, groups: pa.Table) -> pa.Table:
        con = duck()
        con.register("k", kept)
        con.register("g0", groups)
        con.execute(f"CREATE OR REPLACE TABLE pairs {ddl}, back HUGEINT); CREATE OR REPLACE TABLE tops {ddl})")
        con.execute("CREATE OR REPLACE TABLE k1 AS SELECT row_number() OVER () AS id, * FROM k")
        con.execute("CREATE OR REPLACE TABLE l AS SELECT lang, CAST(sum(total) AS HUGEINT) AS total, any_value(v) AS v FROM g0 GROUP BY lang")
        for lang, sources, first, last in con.execute("SELECT lang, (SELECT count(*) FROM g0 WHERE g0.lang = a.lang), min(id), max(id) FROM (SELECT lang, id FROM k1) a GROUP BY lang").fetchall():
            step = max(1, most // max(1, sources))
            con.execute("CREATE OR REPLACE TEMP TABLE g AS SELECT * FROM g0 WHERE lang = ?", [lang])
            ids = con.execute("SELECT count(*) FROM k1 WHERE lang = ?", [lang]).fetchall()[0][0]
            con.execute("CREATE OR REPLACE TEMP TABLE k2 AS SELECT *, row_number() OVER (ORDER BY id) - 1 AS place FROM k1 WHERE lang = ?", [lang])
            name = "'" + lang.replace("'", "''") + "'"
            for at in range(0, ids, step):
                con.execute(f"CREATE OR REPLACE TEMP TABLE w AS SELECT id, lang, term, ns, sources FROM k2 WHERE place >= {at} AND place < {at + step}")
                con.execute("CREATE OR REPLACE TEMP TABLE u AS SELECT id, unnest(sources) AS source, unnest(ns) AS n FROM w")
                con.execute(_SHARES)
                con.execute(_PAIRS.format(lang=name))
                con.execute(_TOP.format(lang=name, top=top))
        return con.sql(f"""
SELECT lang, source, item, CAST(sum(value) AS BIGINT) AS value, true AS is_pair FROM (SELECT lang, source, item, back AS value FROM (SELECT lang, item AS source, source AS item, back FROM pairs) UNION ALL SELECT lang, source, item, value FROM pairs) GROUP BY ALL
UNION ALL SELECT lang, source, item, CAST(value AS BIGINT), false FROM (SELECT * FROM tops QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= {top})""").to_arrow_table()

    return run


def source_divergence(docs: DataFrame, min_docs: int = 3, top: int = 200, shard_rows: int = 100_000, least_shards: int = 16) -> DataFrame:
    """docs(text, lang, source) -> (lang, source, part, item, value, rank); see the module for what is defined.

    part `pair`: item is another source of the language, value the sum of its terms' f, all ranks.
    part `term`: item is a term of the source that is more frequent there than in the language, the first
    `top`. f = floor((p - q)^2 / q), p = 1 + floor(10^9 (n + 1) / (N + V)), all in exact integers.
    A shard holds about shard_rows counts; their number follows from the stored counts.
    """
    counts = materialise(term_counts(docs))
    terms = counts.filter("term is not null")
    n = max(least_shards, math.ceil(terms.count() / shard_rows))
    shard = F.pmod(F.xxhash64("lang", "term"), F.lit(n)).cast("int")
    kept = materialise(terms.withColumn("shard", shard).groupBy("shard").applyInArrow(_kept_terms(min_docs), "shard int, lang string, term string, sources array<string>, ns array<long>"))
    held = kept.select("lang", F.explode(F.arrays_zip("sources", "ns")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.ns").alias("total"))
    kinds = kept.groupBy("lang").agg(F.count("*").alias("v"))
    groups = counts.filter("term is null").select("lang", "source").join(held, ["lang", "source"], "left").join(kinds, "lang", "left")
    groups = materialise(groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v")))
    every = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    sums = materialise(kept.groupBy("shard").cogroup(every.groupBy("shard")).applyInArrow(_shard_sums(top), "lang string, source string, item string, value long, is_pair boolean"))
    # every pair of a language is a row of the result
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    found = sums.filter("is_pair").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.join(found, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    by = W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    best = sums.filter("not is_pair").select("lang", "source", F.lit("term").alias("part"), "item", "value", F.pmod(F.xxhash64("item"), F.lit(32)).alias("salt"))
    some = W.partitionBy("lang", "source", "part", "salt").orderBy(F.desc("value"), "item")
    best = best.withColumn("r", F.row_number().over(some)).filter(F.col("r") <= top).drop("r", "salt")
    best = best.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(by)).unionByName(best)


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
DIVERGENCE_SQL = rf"""
WITH r AS (SELECT row_number() OVER () AS r, {_LOW} AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
c AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM r) GROUP BY ALL),
k AS (SELECT lang, term FROM c GROUP BY ALL HAVING count(*) >= 3), v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
n AS (SELECT lang, source, term, sum(n) AS n FROM c JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(t, 0) AS total, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM r) LEFT JOIN (SELECT lang, source, sum(n) AS t FROM n GROUP BY ALL) USING (lang, source) LEFT JOIN v USING (lang)),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, CAST(1 + (CAST({SCALE} AS HUGEINT) * (coalesce(n, 0) + 1)) // (total + v) AS BIGINT) AS p FROM k JOIN g USING (lang) LEFT JOIN n USING (lang, source, term)),
q AS (SELECT lang, term, CAST(1 + (CAST({SCALE} AS HUGEINT) * (sum(n) + 1)) // (any_value(total) + any_value(v)) AS BIGINT) AS q FROM n JOIN (SELECT lang, sum(total) AS total, any_value(v) AS v FROM g GROUP BY lang) USING (lang) GROUP BY lang, term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200"""
