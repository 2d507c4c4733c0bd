"""Operators and the whole pipeline against plain versions on the smallest table."""
import base64
import hashlib
import math
import re

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
from cadenza.llm import licenses, mixing, pii, quality  # noqa: E402
from tests.llm.test_llm import brute_fp, line_brute  # noqa: E402
from tests.llm.test_rows import groups  # noqa: E402

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


def plain_features(t):
    def shares(x):
        w = x.split()
        odd = len(re.findall(r"[#%&*$!|@~^=<>{}\[\]\\/_]", x))
        return [odd / max(1, len(x)), sum(a.isupper() for a in w) / max(1, len(w)), sum(w[i] == w[i + 1] for i in range(len(w) - 1)) / max(1, len(w)), len(set(w)) / max(1, len(w)), sum(c.isalpha() for c in x) / max(1, len(x)), len(w)]

    whole, long = shares(t), [x for x in t.split("\n") if len(x) >= 40] or [t]
    each = [shares(x) for x in long] if len(long) > 1 else [whole]
    bad = [x[5] for x in each if x[0] > 0.05 or x[1] > 0.5 or x[2] > 0.3 or (x[3] < 0.3 and x[5] > 20)]
    share = sum(bad) / (sum(x[5] for x in each) or 1)
    return [*whole[:5], math.log(1 + whole[5]), *[max(x[k] for x in each) for k in range(3)], min(x[4] for x in each), share, float(share > 0), t.count("\n") / (len(t) + 1), len("".join(t.split())) / max(1, whole[5]) / 10]


def test_quality_scores_equal_a_plain_model(spark, rows):
    import zlib

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{D}/labels.parquet").collect() if r.quality is not None}
    x = {r[0]: plain_features(r[1] or "") for r in rows}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d in x}
    train = sorted(d for d in labels if d in x and not held[d])
    mu, sd, w, t, slope = (np.array(v) for v in quality.fit([x[d] for d in train], [labels[d] for d in train]))
    score = {d: 1 / (1 + math.exp(-(float(np.clip((np.array(v) - mu) / sd, -8, 8) @ w - t) * float(slope) + math.log(0.3 / 0.7)))) for d, v in x.items()}
    got = quality.quality_scores(spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.score - score[r.doc_id]) < 1e-9 and r.held_out == held[r.doc_id] and r.predicted == (r.score >= 0.3)


def test_fit_orders_pairs():
    """The weights are where the gradient of the pairs' logistic loss vanishes."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.5 * rng.normal(size=400) > 0).astype(int)
    mu, sd, w, _, _ = (np.array(v) for v in quality.fit(x, y, pairs=20_000))
    z = (x - mu) / sd
    every = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, 3)
    slope = (every / (1 + np.exp(every @ w))[:, None]).mean(0) - 1e-3 * w
    assert np.abs(slope).max() < 0.02 and w[0] > 5 * abs(w[1:]).max()


def test_em_equals_a_plain_one():
    """Labelers that abstain at random: estimates equal those of arrays over all rows, and come near the truth."""
    rng = np.random.default_rng(4)
    true = rng.random(20000) < 0.3
    votes = np.where(np.where(true[:, None], rng.random((20000, 4)) < (0.9, 0.7, 0.8, 0.65), rng.random((20000, 4)) < (0.05, 0.1, 0.2, 0.1)), 1, -1) * (rng.random((20000, 4)) < (0.9, 0.8, 0.9, 0.7))
    counts = {}
    for v in map(tuple, votes.tolist()):
        counts[v] = counts.get(v, 0) + 1
    prior, yes, no = pii.em(counts)
    p, a, b = 0.3, np.full(4, 0.8), np.full(4, 0.2)
    odds = lambda q: np.where(votes > 0, q, np.where(votes < 0, 1 - q, 1)).prod(1)
    for _ in range(60):
        one, two = p * odds(a), (1 - p) * odds(b)
        r = one / (one + two)
        p = min(0.4, max(0.02, (1 + r.sum()) / (4 + len(r))))
        a = np.clip((8 + r @ (votes > 0)) / (10 + r @ (votes != 0)), 0.55, 0.999)
        b = np.clip((2 + (1 - r) @ (votes > 0)) / (10 + (1 - r) @ (votes != 0)), 0.001, 0.45)
    assert abs(p - prior) < 1e-9 and np.allclose(a, yes) and np.allclose(b, no)
    assert abs(prior - 0.3) < 0.03 and np.abs(np.array(yes) - (0.9, 0.7, 0.8, 0.65)).max() < 0.06 and np.abs(np.array(no) - (0.05, 0.1, 0.2, 0.1)).max() < 0.06


@pytest.mark.parametrize("votes", [(0, -1, -1, 0), (0, 0, 0, -1), (-1, 0, 0, 0), (0, 0, 0, 0)])
def test_one_pattern_that_nobody_votes_for_is_rejected(votes):
    """Where all candidates have one vote pattern, the classes keep their places."""
    prior, yes, no = pii.em({votes: 70})
    assert pii.posterior(votes, prior, yes, no) < 0.5
    w0, wv, size, place = pii.classifier([(votes, 1, 5, 70)])
    assert w0 + sum(p if v > 0 else q if v < 0 else 0 for v, (p, q) in zip(votes, wv)) + size[1] + place[5] < 0


def test_planted_secrets_and_persons(spark):
    """Spans planted in prose among license names, repeated words, places and hashes: precision and recall of both kinds."""
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("aeionrstlm"), rng.integers(2, 9)))
    prose = lambda: " ".join(word() for _ in range(rng.integers(5, 30)))
    code = lambda n: "".join(rng.choice(list("abcdefghjkmnpqrstuvwxyz23456789ABCDEFGHJK"), n))
    given, family = list(rng.choice(pii.GIVEN, 60, replace=False)), ["Weber", "Carter", "Rossi", "Novak", "Okafor", "Lindqvist", "Moreau", "Tanaka"]
    name = lambda: f"{rng.choice(given)} {rng.choice(family)}"
    other = lambda: f"{word().title()}x {rng.choice(family)}"
    planted = {
        "person": [lambda: ("Mr. ", name(), " said"), lambda: ("signed: ", name(), "\n"), lambda: ("and ", name(), " came"), lambda: ("patient: ", other(), ", aged"), lambda: ("and ", f"{rng.choice(given)} Q. {rng.choice(family)}", " went")],
        "secret": [lambda: ("password=", code(18) + "7a1", " "), lambda: ('token = "', code(30) + "b2", '" '), lambda: ("AKIA: ", "AKIA" + "Q7Z" + code(13).upper(), " ")],
        "": [lambda: ("under the ", "Apache License", ", Version"), lambda: ("the GNU ", "General Public License", ", version"), lambda: ("", "The The The", " The"), lambda: ("in ", "New York", " there"), lambda: ("the ", "Supreme Court", " of"),
             lambda: ("commit ", "3f2a9c4b7d1e", " "), lambda: ("see ", "document20241231", " "), lambda: ("/img/", "photo20240102x", ".png")],
    }
    rows, want = [], {"person": set(), "secret": set()}
    for i in range(600):
        text = ""
        for kind in rng.choice(list(planted), 2):
            a, v, b = planted[kind][rng.integers(len(planted[kind]))]()
            text += prose() + "\n" + prose() + " " + a
            if kind:
                want[kind].add((i, len(text), len(text) + len(v)))
            text += v + b
        rows.append((i, text))
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for kind, truth in want.items():
        found = {(r.doc_id, s.start, s.end) for r in got for s in r[kind]}
        assert len(found & truth) / len(found) > 0.97 and len(found & truth) / len(truth) > 0.95, (kind, len(found & truth), len(found), len(truth), sorted(found - truth)[:3], sorted(truth - found)[:3])


def test_overlaps_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        cuts = sorted(rng.choice(60, 2 * rng.integers(0, 6), replace=False).tolist())
        s = int(rng.integers(0, 58))
        rows.append((i, list(zip(cuts[::2], cuts[1::2])), (s, s + int(rng.integers(1, 9)))))
    d = spark.createDataFrame(rows, "i int, b array<struct<start:int,end:int>>, c struct<start:int,end:int>")
    got = {r.i: r.o for r in d.select("i", pii.overlaps(pii.F.col("b"), pii.F.col("c")).alias("o")).collect()}
    assert got == {i: any(x < c[1] and c[0] < y for x, y in b) for i, b, c in rows}


def test_added_spans(spark):
    """Secrets and names are found by several labelers together; base spans win where they overlap."""
    prose = "nothing to see here but ordinary words of some length " * 20
    texts = [f"{prose} key {i}: password=a1b2c3d4e5f6a7b{i % 10}c" for i in range(12)] + [f"{prose} AKIA{'QWERTZUIOPASDFG'[i % 3 :]}7H2K" for i in range(9)]
    texts += ["Dear Mr. James Carter, thanks.", "signed: Anna Maria Weber", "mail token=a1b2c3d4e5f6a7b8@x.org now", prose, None]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_pii(d).collect()}
    assert all(len(got[i].secret) == 1 for i in range(21)) and got[2].secret[0].value == "a1b2c3d4e5f6a7b2c"
    assert [p.value for p in got[21].person] == ["James Carter"] and [p.value for p in got[22].person] == ["Anna Maria Weber"]
    assert got[23].secret == [] and len(got[23].email) == 1 and not any(got[24][k] or got[25][k] for k in (*pii.KINDS, *pii.ADDED))


def test_license_notices_of_the_table(spark, rows):
    """Every notice that stands as a whole sentence, found by plain search."""
    notices = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Released under the MIT License.": "MIT"}
    want = {(d, m.start(), n) for d, t, *_ in rows for text, n in notices.items() for m in re.finditer(re.escape(text), t or "")}
    got = {(r.doc_id, r.start, r.license) for r in licenses.license_scan(spark.read.parquet(f"{D}/documents.parquet")).collect()}
    assert want and got == want


def raked(cells):
    """{(source, lang, topic): tokens} -> ratio of raked to observed share, by loops."""
    n = sum(cells.values())
    w = {c: v / n for c, v in cells.items()}
    target = []
    for k in range(3):
        share = {}
        for c, v in w.items():
            share[c[k]] = share.get(c[k], 0) + v
        tempered = {v: s**0.7 for v, s in share.items()}
        target.append({v: s / sum(tempered.values()) for v, s in tempered.items()})
    for _ in range(300):
        for k in range(3):
            now = {}
            for c, v in w.items():
                now[c[k]] = now.get(c[k], 0) + v
            w = {c: v * target[k][c[k]] / now[c[k]] for c, v in w.items()}
    return {c: w[c] * n / cells[c] for c in cells}


def test_pipeline_equals_a_plain_chain(spark, rows):
    import tiktoken

    docs, labels = spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")
    good = {r.doc_id for r in quality.quality_scores(docs, labels).collect() if r.predicted == 1}
    kept = [r for r in rows if r[0] in good]
    cut = {d: t for d, _, _, t in line_brute([(r[0], r[1]) for r in kept])}
    fps = {d: brute_fp(t) for d, t in cut.items()}
    ids = sorted(fps)
    first = {min(g) for g in groups(ids, [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 4])}

    def topic(t):
        return next((n for n, cue in mixing.TOPICS.items() if re.search(cue, t)), "general")

    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    cell = {r[0]: (r[3] or "unknown", r[2] or "unknown", topic(cut[r[0]])) for r in kept if r[0] in first}
    cells = {}
    for d, c in cell.items():
        cells[c] = cells.get(c, 0) + words(cut[d])
    ratio = raked({c: n for c, n in cells.items() if n})
    u = lambda d: int(hashlib.md5(f"11:{d}".encode()).hexdigest()[:8], 16) / 2**32
    want = {d: max(1.0, ratio.get(c, 1.0)) for d, c in cell.items() if u(d) < min(1.0, ratio.get(c, 1.0))}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, D).collect()}
    assert set(got) == set(want) and len(want) > 20
    for d, r in got.items():
        assert r.text == cut[d] and r.n_chars == len(cut[d]) and abs(r.weight - want[d]) < 1e-3
        assert r.token_ids == own.encode_ordinary(cut[d]) and r.n_tokens == len(r.token_ids)
