"""Exact percentiles by distributed selection: ranges of values are narrowed by counts, no task holds a group.

Each round takes percentiles of every group's open range with a mergeable sketch, counts what lies below
and at the two that enclose a wanted rank, and keeps the range between them. A range of few values is read
whole at the end. Pivots are values of the group, so a range loses at least one of its values a round.
"""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.session import stored

#: Steps of the percentiles that enclose a rank, and the accuracy of the sketch that gives them.
STEPS, ACCURACY = 256, 10_000


def _ranks(n, p):
    at = F.lit(float(p)) * (n - 1)
    return F.floor(at).cast("long"), F.ceil(at).cast("long")


def percentile(rows: DataFrame, keys: list[str], value: str, p: float, most: int = 100_000, name: str = "p") -> DataFrame:
    """rows(keys, value) -> (keys, name): the interpolated percentile of the values of each group that are not null.

    Groups of at most `most` values are sorted whole; in a larger one its two ranks are looked for. Groups
    without values have null; keys may be null; not-a-number is larger than all numbers, as Spark sorts it.
    rows is read once to count, and for large groups twice a round: store it first where it is costly.
    """
    v = rows.select(*keys, F.col(value).cast("double").alias("v"))
    size = stored(v.groupBy(*keys).agg(F.count("v").alias("n")))
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    v = v.filter("v is not null")
    big = size.filter(F.col("n") > most)
    small = v.alias("v").join(size.filter(F.col("n").between(1, most)).alias("s"), same("v", "s"), "left_semi").groupBy(*keys).agg(F.percentile("v", F.lit(float(p))).alias(name))
    out = size.filter("n = 0").select(*keys, F.lit(None).cast("double").alias(name)).unionByName(small)
    if big.isEmpty():
        return out
    # one row a group and wanted rank: k-th of the values between low and high (both open; null: unbounded)
    lo, hi = _ranks(F.col("n"), p)
    todo = big.select(*keys, F.explode(F.array(*[F.struct(F.lit(t).alias("t"), r.alias("k")) for t, r in enumerate((lo, hi))])).alias("x"), "n")
    none = F.lit(None).cast("double")
    todo = stored(todo.select(*keys, "x.t", "x.k", F.col("n").alias("left"), none.alias("low"), none.alias("high")))
    found = []
    while True:
        inside = lambda s: (F.col(f"{s}.low").isNull() | (F.col("v.v") > F.col(f"{s}.low"))) & (F.col(f"{s}.high").isNull() | (F.col("v.v") < F.col(f"{s}.high")))
        few = todo.filter(F.col("left") <= most)
        held = v.alias("v").join(few.alias("s"), [*same("v", "s"), inside("s")]).groupBy(*[F.col(f"s.{k}") for k in keys], "t", F.col("s.k").alias("k")).agg(F.array_sort(F.collect_list("v.v")).alias("all"))
        found.append(stored(held.select(*keys, "t", F.get("all", F.col("k").cast("int")).alias("x"))))
        todo = stored(todo.filter(F.col("left") > most))
        if todo.isEmpty():
            break
        points = F.percentile_approx("v.v", [i / STEPS for i in range(STEPS + 1)], ACCURACY)
        near = v.alias("v").join(todo.alias("s"), [*same("v", "s"), inside("s")]).groupBy(*[F.col(f"s.{k}") for k in keys], *[F.col(f"s.{k}").alias(k) for k in ("t", "k", "left", "low", "high")]).agg(points.alias("points"))
        step = F.floor(F.col("k") / F.col("left") * STEPS).cast("int")
        near = near.withColumns({"a": F.get("points", F.greatest(step - 1, F.lit(0))), "b": F.get("points", F.least(step + 2, F.lit(STEPS)))}).drop("points")
        near = stored(near)
        below = [F.count_if(F.col("v.v") < F.col("s.a")).alias("lt_a"), F.count_if(F.col("v.v") <= F.col("s.a")).alias("le_a"), F.count_if(F.col("v.v") < F.col("s.b")).alias("lt_b"), F.count_if(F.col("v.v") <= F.col("s.b")).alias("le_b")]
        own = [F.col(f"s.{k}").alias(k) for k in (*keys, "t", "k", "left", "low", "high", "a", "b")]
        c = stored(v.alias("v").join(near.alias("s"), [*same("v", "s"), inside("s")]).groupBy(*own).agg(*below))
        k = F.col("k")
        at_a, at_b = (k >= F.col("lt_a")) & (k < F.col("le_a")), (k >= F.col("lt_b")) & (k < F.col("le_b"))
        found.append(c.filter(at_a | at_b).select(*keys, "t", F.when(at_a, F.col("a")).otherwise(F.col("b")).alias("x")))
        before, after = k < F.col("lt_a"), k >= F.col("le_b")
        todo = stored(c.filter(~at_a & ~at_b).select(
            *keys, "t", F.when(before, k).when(after, k - F.col("le_b")).otherwise(k - F.col("le_a")).alias("k"),
            F.when(before, F.col("lt_a")).when(after, F.col("left") - F.col("le_b")).otherwise(F.col("lt_b") - F.col("le_a")).alias("left"),
            F.when(before, F.col("low")).when(after, F.col("b")).otherwise(F.col("a")).alias("low"), F.when(before, F.col("a")).when(after, F.col("high")).otherwise(F.col("b")).alias("high")))
    x = found[0]
    for f in found[1:]:
        x = x.unionByName(f)
    both = x.groupBy(*keys).agg(F.max(F.when(F.col("t") == 0, F.col("x"))).alias("x0"), F.max(F.when(F.col("t") == 1, F.col("x"))).alias("x1"))
    at = F.lit(float(p)) * (F.col("n") - 1)
    both = both.alias("b").join(big.alias("s"), same("b", "s"))
    return out.unionByName(both.select(*[F.col(f"s.{k}").alias(k) for k in keys], F.when(F.col("x0") == F.col("x1"), F.col("x0")).otherwise(F.col("x0") + (F.col("x1") - F.col("x0")) * (at - F.floor(at))).alias(name)))
