"""Exact percentiles against numpy."""
import numpy as np
import pytest

from cadenza.plans.selection import percentile


@pytest.mark.parametrize("most", [3, 50, 100_000])
def test_percentiles_are_exact(spark, most):
    rng = np.random.default_rng(1)
    groups = {"wide": np.exp(rng.uniform(-200, 200, 3000)), "two": np.array([5.0] * 900 + [7.0] * 48), "one": np.full(4000, 2.5), "few": np.array([1.0, 9.0]), "ties": rng.integers(0, 9, 2500).astype(float), None: rng.normal(size=700), "single": np.array([4.0])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("few", None)] * 200 + [("empty", None)]
    d = spark.createDataFrame(rows, "g string, x double").repartition(5)
    for p in (0.95, 0.5, 0.0, 1.0):
        got = {r.g: r.p for r in percentile(d, ["g"], "x", p, most=most).collect()}
        assert set(got) == {*groups, "empty"} and got["empty"] is None
        for k, vs in groups.items():
            assert np.isclose(got[k], np.quantile(vs, p), rtol=1e-12), (k, p)


def test_a_large_clip_is_never_one_group(spark):
    """No task of the last step reads more than `most` values of the group."""
    d = spark.range(0, 300_000, 1, 6).selectExpr("'c' AS g", "CAST((id * 7919) % 300007 AS DOUBLE) AS x")
    want = np.quantile((np.arange(300_000) * 7919) % 300007, 0.95)
    assert np.isclose(percentile(d, ["g"], "x", 0.95, most=5000).first().p, want, rtol=1e-12)
