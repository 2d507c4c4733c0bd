"""Decision rules as column expressions: evaluator scores (1 to 5), quality and performance (0 to 10), status texts."""
from functools import reduce

from pyspark.sql import functions as F

from cadenza.functions.scalars import clamp
from cadenza.session import table

#: Weights of the scores; the survey's weight counts only where there is a survey.
WEIGHTS = {"player": 0.15, "ball": 0.15, "temporal": 0.15, "occlusion": 0.10, "camera": 0.10, "pitch": 0.05, "graphics": 0.10, "goal": 0.05}
SURVEY_WEIGHT = 0.15
#: The texts of the recommendation.
ADVICE = {
    "technical": "REJECTED (Technical integrity check failed)",
    "candidate": "PRODUCTION CANDIDATE",
    "unmeasured": "PRODUCTION CANDIDATE (Quality: EXCELLENT; measure on 3x L40S to verify RTF)",
    "reservations": "ACCEPTABLE WITH RESERVATIONS",
    "slow": "REJECTED (Performance below 1.0-1.3x realtime target)",
    "visual": "REJECTED (Visual quality below broadcast thresholds)",
}


def rate(n, d):
    """n / d, where d counts as 1 at least."""
    return n / F.greatest(F.lit(1.0), d.cast("double"))


def off(full, share, most):
    """The part of `most` that a share of its limit takes, never more than `most`."""
    return F.least(F.lit(float(most)), share / full * most)


def ball(pitch, active, matched, dissolved, duplicate, wobble, deformed):
    x = 5 - F.least(F.lit(2.5), rate(dissolved, active) * 4) - off(0.15, rate(duplicate, matched), 1.5) - off(0.15, rate(wobble, matched), 1) - off(0.15, rate(deformed, matched), 0.5)
    return F.when(~pitch | (active == 0), 5.0).otherwise(clamp(x, 1.0, 5.0))


def ball_sequence(frames, tracked, teleports, duplicates, deformed, pitch_share, has_ball, source_tracked):
    """Score of a clip's ball track: what is wrong with it for each tracked frame, and what of it is not there."""
    expected = F.coalesce(has_ball, pitch_share >= 0.15)
    kept = tracked / F.greatest(F.lit(1), source_tracked * 2)
    seen = tracked / frames
    gone = F.when(source_tracked.isNotNull(), F.when(kept < 0.70, off(0.70, 0.70 - kept, 2)))
    gone = F.when(source_tracked.isNotNull(), gone).when((pitch_share >= 0.40) & (frames >= 60) & (seen < 0.08), off(0.08, 0.08 - seen, 1.5))
    x = 5 - off(0.15, rate(duplicates, tracked), 2) - off(0.15, rate(teleports, tracked), 1.5) - off(0.15, rate(deformed, tracked), 1) - F.coalesce(gone, F.lit(0.0))
    return F.when(~expected, 5.0).when(tracked == 0, 1.0).otherwise(clamp(x, 1.0, 5.0))


def player(anomalies, checked):
    return clamp(5 - F.least(F.lit(3.5), rate(anomalies, checked) * 25), 1.0, 5.0)


def occlusion(failed, seen):
    return clamp(5 - F.least(F.lit(3.5), rate(failed, seen) * 5), 1.0, 5.0)


def pitch(on_pitch, residual, warps, triplets):
    x = 5 - F.least(F.lit(2.5), (residual - 0.012) / 0.035 * 2.5) - off(0.05, rate(warps, triplets), 2)
    return F.when(on_pitch & (triplets > 0) & (residual > 0.012), clamp(x, 1.0, 5.0)).otherwise(5.0)


def pitch_sequence(frames, wobbles, drops):
    """From lines off their bundle for each frame, and sudden changes of their number for each step."""
    steps = F.when(frames > 1, off(0.05, drops / (frames - 1), 1.5)).otherwise(0.0)
    return clamp(5 - off(0.10, wobbles / frames, 2.5) - steps, 1.0, 5.0)


def goal(even, odd, samples):
    """From the mean net texture at even and at odd places of the list."""
    apart = F.abs(even - odd) / (even + 1e-5)
    return F.when((samples >= 4) & (apart > 0.20), clamp(5 - F.least(F.lit(2.5), apart * 4), 1.0, 5.0)).otherwise(5.0)


def graphics(jitter):
    return F.when(jitter > 3, clamp(5 - F.least(F.lit(3.0), (jitter - 3) * 0.4), 1.0, 5.0)).otherwise(5.0)


def camera(events, shifts):
    return F.when(shifts > 1, clamp(5 - F.least(F.lit(3.0), rate(events, shifts) * 8), 1.0, 5.0)).otherwise(5.0)


def smoothness(breaks, vectors, acceleration):
    return F.greatest(F.lit(0.0), 1 - off(0.02, rate(breaks, vectors), 0.6) - F.least(F.lit(0.4), acceleration / 10))


def temporal_status(smooth, warp):
    return F.when((smooth >= 0.85) & (warp < 15), "EXCELLENT").when((smooth < 0.65) | (warp > 28), "POOR").when(smooth < 0.75, "FAIR").otherwise("GOOD")


def stability(smooth, flicker):
    return F.greatest(F.lit(1.0), 1 + 4 * smooth - F.least(F.lit(2.0), flicker * 0.5))


def opinion(player, ball, occlusion, pitch, graphics, camera):
    """Stands in for a survey; the goal does not count."""
    return clamp((player + ball + occlusion + pitch + graphics + camera) / 6, 1.0, 5.0)


def quality(scores: dict, survey=None):
    """Twice the weighted mean; survey: null where nobody was asked."""
    own = reduce(lambda a, b: a + b, [F.lit(w) * scores[k] for k, w in WEIGHTS.items()])
    survey = F.lit(None).cast("double") if survey is None else survey
    return 2 * F.coalesce(own + SURVEY_WEIGHT * survey, own / sum(WEIGHTS.values()))


def quality_status(q):
    return F.when(q >= 8.5, "EXCELLENT").when(q >= 7.5, "GOOD").when(q >= 6, "ACCEPTABLE").otherwise("POOR")


def performance(factor):
    """(score, status) of a realtime factor; null and UN-EVALUATED where it was not measured."""
    score = F.when(factor <= 1, 10.0).when(factor <= 1.3, 10 - (factor - 1) / 0.3 * 1.5).when(factor <= 1.6, 8.5 - (factor - 1.3) / 0.3 * 2.5)
    status = F.when(factor.isNull(), "UN-EVALUATED").when(factor <= 1.3, "PASS").when(factor <= 1.6, "WARN").otherwise("FAIL")
    return F.when(factor.isNotNull(), F.coalesce(score, F.greatest(F.lit(1.0), 6 - 2 * (factor - 1.6)))), status


def recommendation(passed, q, status):
    best = F.when(status == "PASS", ADVICE["candidate"]).otherwise(ADVICE["unmeasured"])
    out = F.when(~passed, ADVICE["technical"]).when((q >= 7.8) & status.isin("PASS", "UN-EVALUATED"), best)
    return out.when((q >= 6.5) & status.isin("PASS", "WARN", "UN-EVALUATED"), ADVICE["reservations"]).when(status == "FAIL", ADVICE["slow"]).otherwise(ADVICE["visual"])


def severity(added):
    return F.when(added < 0.01, 1).when(added < 0.03, 2).when(added < 0.07, 3).when(added < 0.15, 4).otherwise(5)


# -- the rules on the driver's tables: counts of line items stand for detector counts -------------------


def _counts(spark, sf_dir):
    """One row per order: counts of its line items, as a clip's counters."""
    n = lambda c: F.count_if(c)
    item = table(spark, sf_dir, "lineitem")
    return item.groupBy("l_orderkey").agg(
        F.count("*").alias("n"), n(F.col("l_returnflag") == "R").alias("a"), n(F.col("l_linestatus") == "F").alias("b"), n(F.col("l_discount") >= 0.05).alias("c"),
        n(F.col("l_tax") >= 0.04).alias("d"), F.min("l_discount").alias("lo"), F.max("l_quantity").alias("hi"), F.max("l_tax").alias("tax"))


def _scores(spark, sf_dir):
    c, x = F.col, _counts(spark, sf_dir)
    s = {
        "player": player(c("a"), c("n") * 10), "ball": ball(c("n") > 1, c("n"), c("n") - c("a"), c("a"), c("b"), c("c"), c("d")), "occlusion": occlusion(c("c"), c("n") * 2),
        "pitch": pitch(c("n") > 2, c("lo") + 0.01, c("d"), c("n") * 20), "goal": goal(c("tax") * 10 + 1, c("lo") * 10 + 1, c("n")), "graphics": graphics(c("hi") / 5),
        "camera": camera(c("b"), c("n") * 4), "smooth": smoothness(c("a"), c("n") * 50, c("hi") / 20),
    }
    x = x.withColumns(s)
    return x.withColumn("temporal", stability(c("smooth"), c("tax") * 8))


def evaluator_ladder(spark, sf_dir):
    return _scores(spark, sf_dir).select("l_orderkey", *[F.round(k, 6).alias(k) for k in (*WEIGHTS, "smooth")], temporal_status(F.col("smooth"), F.col("hi")).alias("status"))


def scorecard_ladder(spark, sf_dir):
    """Quality with and without survey, performance and recommendation of every order."""
    x = _scores(spark, sf_dir)
    c = {k: F.col(k) for k in WEIGHTS}
    survey = F.when(F.col("n") % 2 == 0, opinion(*[c[k] for k in ("player", "ball", "occlusion", "pitch", "graphics", "camera")]))
    factor = F.when(F.col("n") % 3 > 0, F.col("hi") / 25)
    score, status = performance(factor)
    x = x.withColumns({"quality": F.round(quality(c, survey), 6), "score": score, "speed": status})
    return x.select("l_orderkey", "quality", quality_status(F.col("quality")).alias("status"), F.round("score", 6).alias("performance"), "speed", recommendation(F.col("a") < 5, F.col("quality"), F.col("speed")).alias("advice"))


QUERIES = {f.__name__: f for f in (evaluator_ladder, scorecard_ladder)}
_ROWS = """n AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS a, count(*) FILTER (l_linestatus = 'F') AS b, count(*) FILTER (l_discount >= 0.05) AS c, count(*) FILTER (l_tax >= 0.04) AS d,
  CAST(min(l_discount) AS DOUBLE) AS lo, CAST(max(l_quantity) AS DOUBLE) AS hi, CAST(max(l_tax) AS DOUBLE) AS tax FROM lineitem GROUP BY l_orderkey),
r AS (SELECT *, greatest(1, n - a)::DOUBLE AS matched, abs((tax * 10 + 1) - (lo * 10 + 1)) / ((tax * 10 + 1) + 1e-5) AS apart FROM n),
s AS (SELECT *, greatest(1.0::DOUBLE, 5 - least(3.5::DOUBLE, 25 * (a / (n * 10)::DOUBLE))) AS player,
  CASE WHEN n <= 1 THEN 5.0::DOUBLE ELSE greatest(1.0::DOUBLE, 5 - least(2.5::DOUBLE, 4 * (a / n::DOUBLE)) - least(1.5::DOUBLE, b / matched / 0.15::DOUBLE * 1.5::DOUBLE) - least(1.0::DOUBLE, c / matched / 0.15::DOUBLE) - least(0.5::DOUBLE, d / matched / 0.15::DOUBLE * 0.5::DOUBLE)) END AS ball,
  greatest(1.0::DOUBLE, 5 - least(3.5::DOUBLE, 5 * (c / (n * 2)::DOUBLE))) AS occlusion,
  CASE WHEN n > 2 AND lo + 0.01::DOUBLE > 0.012::DOUBLE THEN greatest(1.0::DOUBLE, 5 - least(2.5::DOUBLE, (lo + 0.01::DOUBLE - 0.012::DOUBLE) / 0.035::DOUBLE * 2.5::DOUBLE) - least(2.0::DOUBLE, d / (n * 20)::DOUBLE / 0.05::DOUBLE * 2)) ELSE 5.0::DOUBLE END AS pitch,
  CASE WHEN n >= 4 AND apart > 0.2::DOUBLE THEN greatest(1.0::DOUBLE, 5 - least(2.5::DOUBLE, 4 * apart)) ELSE 5.0::DOUBLE END AS goal,
  CASE WHEN hi / 5 > 3 THEN greatest(1.0::DOUBLE, 5 - least(3.0::DOUBLE, (hi / 5 - 3) * 0.4::DOUBLE)) ELSE 5.0::DOUBLE END AS graphics,
  greatest(1.0::DOUBLE, 5 - least(3.0::DOUBLE, 8 * (b / (n * 4)::DOUBLE))) AS camera,
  greatest(0.0::DOUBLE, 1 - least(0.6::DOUBLE, a / (n * 50)::DOUBLE / 0.02::DOUBLE * 0.6::DOUBLE) - least(0.4::DOUBLE, hi / 200)) AS smooth FROM r),
t AS (SELECT *, greatest(1.0::DOUBLE, 1 + 4 * smooth - least(2.0::DOUBLE, tax * 4)) AS temporal FROM s)"""
ORACLES = {
    "evaluator_ladder": f"""WITH {_ROWS} SELECT l_orderkey, {", ".join(f"round({k}, 6) AS {k}" for k in (*WEIGHTS, "smooth"))},
 CASE WHEN smooth >= 0.85 AND hi < 15 THEN 'EXCELLENT' WHEN smooth < 0.65 OR hi > 28 THEN 'POOR' WHEN smooth < 0.75 THEN 'FAIR' ELSE 'GOOD' END AS status FROM t""",
    "scorecard_ladder": f"""WITH {_ROWS}, w AS (SELECT *, 0.15::DOUBLE * (player + ball + temporal) + 0.1::DOUBLE * (occlusion + camera + graphics) + 0.05::DOUBLE * (pitch + goal) AS own,
  least(5.0::DOUBLE, greatest(1.0::DOUBLE, (player + ball + occlusion + pitch + graphics + camera) / 6)) AS mos, CASE WHEN n % 3 > 0 THEN hi / 25 END AS f FROM t),
q AS (SELECT *, round(2 * CASE WHEN n % 2 = 0 THEN own + 0.15::DOUBLE * mos ELSE own / 0.85::DOUBLE END, 6) AS quality,
  CASE WHEN f IS NULL THEN 'UN-EVALUATED' WHEN f <= 1.3 THEN 'PASS' WHEN f <= 1.6 THEN 'WARN' ELSE 'FAIL' END AS speed FROM w)
SELECT l_orderkey, quality, CASE WHEN quality >= 8.5 THEN 'EXCELLENT' WHEN quality >= 7.5 THEN 'GOOD' WHEN quality >= 6 THEN 'ACCEPTABLE' ELSE 'POOR' END AS status,
 round(CASE WHEN f <= 1 THEN 10 WHEN f <= 1.3 THEN 10 - 5 * (f - 1) WHEN f <= 1.6 THEN 8.5 - 25 * (f - 1.3) / 3 WHEN f > 1.6 THEN greatest(1, 6 - 2 * (f - 1.6)) END, 6) AS performance, speed,
 CASE WHEN a >= 5 THEN '{ADVICE["technical"]}' WHEN quality >= 7.8 AND speed = 'PASS' THEN '{ADVICE["candidate"]}' WHEN quality >= 7.8 AND speed = 'UN-EVALUATED' THEN '{ADVICE["unmeasured"]}'
  WHEN quality >= 6.5 AND speed <> 'FAIL' THEN '{ADVICE["reservations"]}' WHEN speed = 'FAIL' THEN '{ADVICE["slow"]}' ELSE '{ADVICE["visual"]}' END AS advice FROM q""",
}
