"""Given targets, and raking until every marginal meets its target."""
import itertools

from cadenza.llm import mixing


def cells(spark):
    n = lambda i, s, lang, t: 5000 if (s, lang) in (("a", "x"), ("b", "y")) and (lang, t) in (("x", "u"), ("y", "v")) else 1 + i
    every = enumerate(itertools.product("ab", "xyz", "uv"))
    return spark.createDataFrame([(*c, n(i, *c)) for i, c in every], "source string, lang string, topic string, n long")


def test_given_targets_are_met_on_correlated_cells(spark):
    want = {"source": {"a": 0.8}, "lang": {"x": 0.3, "z": 0.3}}
    x = mixing.rake(cells(spark), 0.7, 12, want, 1e-6).collect()
    share = lambda d, v: sum(r.w for r in x if r[d] == v)
    got = {(d, v): share(d, v) for d, v in (("source", "a"), ("source", "b"), ("lang", "x"), ("lang", "y"), ("lang", "z"))}
    assert all(abs(got[k] - s) < 2e-6 for k, s in {("source", "a"): 0.8, ("source", "b"): 0.2, ("lang", "x"): 0.3, ("lang", "y"): 0.4, ("lang", "z"): 0.3}.items())
    assert mixing.marginal_error(mixing.rake(cells(spark), 0.7, 12, want)) > 1e-6
