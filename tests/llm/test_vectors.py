"""Vector operators: planted links over many blocks, awkward rows, recall against a random order."""
import numpy as np
import pytest

from cadenza.llm import vectors

SCHEMA = "vec_id long, embedding array<double>, label int, `a.b` string, score int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], SCHEMA)


def brute(rows, cosine=0.93):
    """[(vec_id, links, component)] row by row."""
    ok = [v is not None and lab is not None and len(v) > 0 and None not in v and bool(np.isfinite(v).all()) and any(v) for _, v, lab in rows]
    unit = [np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) if o else None for (_, v, _), o in zip(rows, ok)]
    near = {a: [b for b in range(len(rows)) if a != b and ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine] for a in range(len(rows))}
    out = []
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        out.append((rows[a][0], len(near[a]), min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)))
    return sorted(map(str, out))


def got(df):
    return sorted(str((r.vec_id, r.n_links, r.component_id)) for r in df.collect())


def test_links_planted_over_many_blocks(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 64))
    x[300:600] = x[:300] * 3 + rng.normal(size=(300, 64)) * rng.uniform(0.3, 1.3, (300, 1))  # around the threshold
    x[600:640] = x[0] + 0.2 * rng.normal(size=(40, 64))
    x[640:700] = x[1]  # equal vectors
    rows = [(i, x[i].tolist(), i % 2 if i < 300 else (i - 300) % 2 if i < 600 else 0 if i < 640 else 1 if i < 700 else 7) for i in rng.permutation(900).tolist()]
    out = got(vectors.embedding_near_dedup(frame(spark, rows), block=128))
    assert out == brute(rows)
    assert sum(int(x.split(", ")[1]) for x in out) > 4000


def test_near_dedup_awkward_rows(spark):
    a, b = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(1, a, 0), (1, b, 0), (1, a, 0), (2, [2.0, 4.0, 6.01], 0), (None, b, 0), (3, [1e200, 2e200, 3e200], 0), (4, [1e-200, 2e-200, 3e-200], 0), (5, [0.0] * 3, 0),
            (6, None, 0), (7, [], 0), (8, [1.0, None, 2.0], 0), (9, [float("inf"), 1.0, 1.0], 0), (10, a, None), (11, a + [0.0], 0), (12, a, 1), (None, [9.0, -9.0, 9.0], 2), (13, a, -1)]
    out = vectors.embedding_near_dedup(frame(spark, rows)).collect()
    assert sorted(str((r.vec_id, r.n_links, r.component_id)) for r in out) == brute(rows)
    kept = [(r.vec_id, r.kept) for r in out]
    assert all(k is not None for _, k in kept) and not any(k for i, k in kept if i is None)
    assert len(kept) == len(rows)


@pytest.mark.parametrize("n, m, least, stretch", [(1, 1, 3, 256), (63, 64, 1, 10), (130, 257, 5, 64), (200, 65, 8, 256), (5, 300, 9, 2)])
def test_windows_counted_by_prefix_sets(n, m, least, stretch):
    """Counts over sorted projections equal those of all pairs, with ties and at the ends of the range."""
    rng = np.random.default_rng(n)
    p, q = rng.integers(-20, 20, (n, 9)).astype(np.int16), rng.integers(-20, 20, (m, 9)).astype(np.int16)
    p[0], q[-1] = 32767, 32767
    hits = (np.abs(p[:, None].astype(int) - q[None]) <= 6).sum(2)
    got = [x for i, j in vectors.count_windows(p, q, 6, least, stretch) for x in zip(i.tolist(), j.tolist())]
    assert len(got) == len(set(got)) and set(got) == set(zip(*(x.tolist() for x in np.nonzero(hits >= least))))


def test_few_pairs_are_verified():
    """Of unrelated pairs in 64 dimensions fewer than one in a thousand reaches the count."""
    import math

    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 64))
    z = np.round(x / np.linalg.norm(x, axis=1)[:, None] @ vectors.directions(64, 32, 5) * vectors.UNITS).astype(np.int16)
    least = vectors.calibrated(32, math.erf(2 / math.sqrt(2)), 0.99999)
    seen = sum(len(i) for i, _ in vectors.count_windows(z[:1000], z[1000:], int(2 * math.sqrt(0.14) / 8 * vectors.UNITS + 2), least))
    assert seen < 1000


def test_recall_of_the_counts():
    """Pairs at the threshold, by the rule of the operator, in several dimensions."""
    import math

    rng = np.random.default_rng(1)
    far = math.sqrt(2 - 2 * 0.93)
    least = vectors.calibrated(32, math.erf(2 / math.sqrt(2)), 0.99999)
    for dim in (2, 3, 8, 64, 300):
        a, t = rng.normal(size=(2, 4000, dim))
        a /= np.linalg.norm(a, axis=1)[:, None]
        t -= (t * a).sum(1)[:, None] * a
        t /= np.linalg.norm(t, axis=1)[:, None]
        b = 0.9301 * a + math.sqrt(1 - 0.9301**2) * t
        p, q = (np.round(x @ vectors.directions(dim, 32, 5) * vectors.UNITS) for x in (a, b))
        hits = (np.abs(p - q) <= int(2 * far / math.sqrt(dim) * vectors.UNITS + 2)).sum(1)
        assert (hits >= least).mean() > 0.999


def exact(rows, q, k):
    x = {i: v for i, v, _ in rows if i is not None and v is not None and len(v) and any(v)}
    y = np.array(x[q])
    d = sorted((float(np.sqrt(((np.array(v) - y) ** 2).sum())), i) for i, v in x.items() if i != q and len(v) == len(y))
    return d[:k]


def test_neighbours_in_order_with_ties(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(-2, 3, (120, 4)).astype(float)  # many equal distances
    rows = [(i, x[i].tolist(), 0) for i in range(120)] + [(None, x[0].tolist(), 0), (200, [0.0] * 4, 0), (201, None, 0), (202, [1.0, 2.0], 0), (300, [2.0, 1.0], 0), (301, [float("nan")] * 4, 0)]
    v = frame(spark, rows)
    out = vectors.hilbert_neighbours(v, v.filter("vec_id % 100 = 0 or vec_id = 7"), k=5, block=16).collect()
    asked = {i for i in (0, 100, 7, 300) if i == 300 or any(x[i])}
    assert {r.query_id for r in out} == asked
    for q in asked:
        mine = sorted((r.rank, r.vec_id, r.score) for r in out if r.query_id == q)
        want = exact(rows, q, 5)
        assert [r[0] for r in mine] == list(range(1, len(want) + 1))
        assert [r[1] for r in mine] == [i for _, i in want]
        assert np.allclose([r[2] for r in mine], [d for d, _ in want], rtol=1e-12, atol=0)


def test_repeated_ids_and_few_rows(spark):
    v = frame(spark, [(100, [1.0, 0.0], 0), (100, [1.0, 0.1], 0), (1, [1.0, 0.2], 0), (1, [5.0, 5.0], 0)])
    out = [(r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in vectors.hilbert_neighbours(v, v.filter("vec_id = 100")).collect()]
    assert out == [(100, 1, 1, 0.1)]
    one = frame(spark, [(100, [1.0, 0.0], 0)])
    assert vectors.hilbert_neighbours(one, one).count() == 0


def recall(rows, out, k=10):
    found = {}
    for r in out:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    return np.mean([len(found[q] & {i for _, i in exact(rows, q, k)}) / k for q in found])


@pytest.mark.parametrize("latent", [4, 64])
def test_recall_against_brute_force(spark, latent):
    """Windows are small where few directions carry the vectors, and grow where all do."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, latent)) @ rng.normal(size=(latent, 64)) + 0.01 * rng.normal(size=(4000, 64))
    rows, info = [(i, x[i].tolist(), 0) for i in range(4000)], {}
    v = frame(spark, rows)
    out = vectors.hilbert_neighbours(v, v.filter("vec_id % 100 = 0"), block=100, least_rows=100, info=info).collect()
    assert recall(rows, out) >= 0.9
    if latent == 4:
        reach = 4 * (2 * info["h"] + 1) * 100  # rows at most in the windows of four curves
        control = np.mean([len(set(rng.choice(4000, min(4000, reach), replace=False)) & {i for _, i in exact(rows, q, 10)}) / 10 for q in range(0, 4000, 100)])
        assert info["share_a_curve"] < 0.2 and recall(rows, out) > control + 0.3
