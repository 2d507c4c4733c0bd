"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Tokens are whitespace words. A document's topic is the first topic whose cue words it holds, or
"general", unless topics are given. Targets default to observed shares to the power `temper`, renormalised; others can be given.
Defined results: null source, language or text count as "unknown", "unknown" and empty; a document
is kept where its hash is below its probability, so repeated doc_ids share their fate; a cell with
no tokens has probability and weight 1.
"""
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cols, materialise

TOPICS = {"legal": "(?i)licen[sc]e|copyright", "credentials": "(?i)password|token|AKIA", "contact": "@|\\+[0-9]"}
DIMS = ("source", "lang", "topic")


def topic_of(text):
    out = F.lit("general")
    for name, cue in reversed(TOPICS.items()):
        out = F.when(text.rlike(cue), name).otherwise(out)
    return out


def marginal_error(x: DataFrame) -> float:
    """The largest distance of a marginal of w from its target."""
    far = [F.abs(F.sum("w").over(W.partitionBy(d)) - F.col(f"t_{d}")).alias(d) for d in DIMS]
    return x.select(F.greatest(*far).alias("far")).agg(F.coalesce(F.max("far"), F.lit(0.0))).first()[0]


def rake(cells: DataFrame, temper: float, rounds: int, targets: dict | None = None, tolerance: float | None = None, most: int = 300, small: int = 200_000) -> DataFrame:
    """cells(source, lang, topic, n) -> + w, whose marginals meet the targets.

    targets: {dimension: {value: share}}; values not named divide what is left by their tempered
    shares. With a tolerance, rounds go on until no marginal is farther than that from its target;
    a warning gives the distance where `most` rounds do not reach it, as with cells that do not exist.
    A table of at most `small` cells is one partition, so that many rounds are one task; a larger one
    is dealt by the values of a dimension in every step.
    """
    total, n_cells = cells.agg(F.sum("n").cast("double"), F.count("*")).first()
    one = (lambda x: x.coalesce(1)) if n_cells <= small else (lambda x: x)
    x = one(cells).withColumn("w", F.col("n").cast("double") / (total or 1.0))
    for d in DIMS:
        by = W.partitionBy(d)
        x = x.withColumns({f"p_{d}": F.pow(F.sum("w").over(by), F.lit(temper)), f"c_{d}": F.count("*").over(by)})
    x = one(materialise(x))
    # sums over the values of a dimension: each of a value's cells carries an equal part
    norm = x.agg(*[F.sum(F.col(f"p_{d}") / F.col(f"c_{d}")).alias(d) for d in DIMS]).first()
    for d in DIMS:
        t = F.col(f"p_{d}") / (norm[d] or 1.0)
        if named := (targets or {}).get(d):
            given = F.create_map(*[F.lit(y) for v, share in named.items() for y in (v, float(share))])[F.col(d)]
            part = x.agg(F.sum(given / F.col(f"c_{d}")), F.sum(F.when(given.isNull(), t / F.col(f"c_{d}")))).first()
            t = F.coalesce(given, t * (max(0.0, 1 - (part[0] or 0.0)) / (part[1] or 1.0)))
            t = t / (x.agg(F.sum(t / F.col(f"c_{d}"))).first()[0] or 1.0)
        x = x.withColumn(f"t_{d}", t)
    x = x.select("source", "lang", "topic", "n", "w", *[f"t_{d}" for d in DIMS])

    def several(x, k):
        for d in DIMS * k:
            s = F.sum("w").over(W.partitionBy(d))
            x = x.withColumn("w", F.when(s > 0, F.col("w") * F.col(f"t_{d}") / s).otherwise(F.lit(0.0)))
        return one(materialise(x))

    k, step = 0, 6 if n_cells <= small else 3
    while k < rounds:
        x, k = several(x, min(step, rounds - k)), k + step
    if tolerance is not None:
        while (far := marginal_error(x)) > tolerance and k < most:
            x, k = several(x, step), k + step
        if far > tolerance:
            warnings.warn(f"mixing: a marginal is {far:.2g} from its target after {k} rounds")
    return x


def mix_to_targets(docs: DataFrame, temper: float = 0.7, rounds: int = 12, seed: int = 11, targets: dict | None = None, tolerance: float | None = None, key: str = "CAST(doc_id AS STRING)", carry=(), topic: str | None = None, broadcast_cells: int = 1_000_000) -> DataFrame:
    """docs(doc_id, text, source, lang) -> (doc_id, source, lang, topic, n_tokens, probability, weight, selected).

    ratio = raked share over observed share of a cell. Cells above their target are sampled with
    that probability; cells below it are kept whole and carry it as a training weight, so expected
    weighted tokens meet the targets and no more documents go than must. targets and tolerance are those of rake; the default is `rounds`
    rounds, as in the SQL. key (SQL, default doc_id) is what the hash is taken of; columns of
    docs named in carry stay on their row, in a struct `row`. topic: SQL of a topic that is known
    already; the default looks for cue words. The ratios of up to broadcast_cells cells are broadcast.
    """
    text = F.coalesce("text", F.lit(""))
    row = [F.struct(*cols(docs, carry)).alias("row")] if carry else []
    topics = topic_of(text) if topic is None else F.coalesce(F.expr(topic).cast("string"), F.lit("general"))
    d = docs.select("doc_id", F.expr(key).alias("key"), *row, F.coalesce("source", F.lit("unknown")).alias("source"), F.coalesce("lang", F.lit("unknown")).alias("lang"),
                    topics.alias("topic"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"))
    d = materialise(d)
    cells = materialise(d.groupBy(*DIMS).agg(F.sum("n_tokens").alias("n")).filter("n > 0"))
    total, n_cells = cells.agg(F.sum("n"), F.count("*")).first()
    fitted = rake(cells, temper, rounds, targets, tolerance)
    p = materialise(fitted.select(*DIMS, (F.col("w") / F.col("n") * F.lit(total or 1)).alias("ratio")))
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("key")).cast("binary")), 1, 8), 16, 10).cast("double") / 2.0**32
    out = d.join(F.broadcast(p) if n_cells <= broadcast_cells else p, list(DIMS), "left").withColumn("ratio", F.round(F.coalesce("ratio", F.lit(1.0)), 9))
    out = out.withColumn("probability", F.least(F.lit(1.0), "ratio")).withColumn("weight", F.greatest(F.lit(1.0), "ratio"))
    return out.withColumn("selected", u < F.col("probability")).select("doc_id", *DIMS, "n_tokens", "probability", "weight", "selected", *(["row"] if carry else []))


def mixing_sql(temper: float = 0.7, rounds: int = 12, seed: int = 11) -> str:
    """The same result in DuckDB SQL, one common table a raking step."""
    topic = " ".join(f"WHEN regexp_matches(x, '{cue}') THEN '{name}'" for name, cue in TOPICS.items())
    share = ", ".join(f"pow(sum(w) OVER (PARTITION BY {d}), {temper}) AS p_{d}, count(*) OVER (PARTITION BY {d}) AS c_{d}" for d in DIMS)
    target = ", ".join(f"p_{d} / sum(p_{d} / c_{d}) OVER () AS t_{d}" for d in DIMS)
    steps, last = [], "s0"
    for k in range(rounds * len(DIMS)):
        d, new = DIMS[k % len(DIMS)], f"s{k + 1}"
        steps.append(f"{new} AS MATERIALIZED (SELECT * REPLACE (w * t_{d} / nullif(sum(w) OVER (PARTITION BY {d}), 0) AS w) FROM {last})")
        last = new
    return rf"""
WITH x AS (SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang, coalesce(text, '') AS x FROM documents),
d AS MATERIALIZED (SELECT doc_id, source, lang, CASE {topic} ELSE 'general' END AS topic, CAST(len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM x),
c AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS n FROM d GROUP BY ALL HAVING sum(n_tokens) > 0),
h AS (SELECT *, n / sum(n) OVER () AS w FROM c), p AS (SELECT *, {share} FROM h), s0 AS MATERIALIZED (SELECT *, {target} FROM p),
{", ".join(steps)},
r AS (SELECT source, lang, topic, w / n * sum(n) OVER () AS ratio FROM {last}),
j AS (SELECT d.*, round(coalesce(ratio, 1.0), 9) AS ratio FROM d LEFT JOIN r USING (source, lang, topic))
SELECT doc_id, source, lang, topic, n_tokens, least(1.0, ratio) AS probability, greatest(1.0, ratio) AS weight,
 CAST('0x' || substr(md5(concat_ws(':', '{seed}', CAST(doc_id AS VARCHAR))), 1, 8) AS BIGINT) / 4294967296.0 < least(1.0, ratio) AS selected FROM j"""
