"""Operators against brute force on small fixtures with awkward rows."""
import base64
import hashlib
import re

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from cadenza.llm import bpe, chat, licenses, line_dedup, mixing, pii, quality, simhash, vectors  # noqa: E402

TEXTS = [
    (1, "The quick brown fox jumps over it\nshort\n  The Quick brown FOX jumps over it\t\nend é"),
    (2, "the quick brown fox jumps over it\nÀ"), (3, "x\nTHE QUICK BROWN FOX JUMPS OVER IT"), (4, ""), (5, None), (5, None),
    (6, "a@b.c_d@e.ff +1 (375) 555-4393 1.2.3.4.5.6.7.256 4207051279108084 4111 1111 1111 1111 999.1.1.1 password=569f672d50d5949088 é😀 x.y@z.w.q"),
    (7, "w " * 3000 + "z" * 3000 + "9" * 5000 + "@" * 50), (8, "don't  stop 123 \n\n\t été ñandú 漢字 😀😀"), (9, "Released under the MIT License."), (10, "one two"),
    (11, "\x0b\x0c  tabs\tand  spaces \r\n one two three four five six"), (12, "\x0b\x0c  tabs\tand  spaces \r\n one two three four five sIx"),
    (None, "the quick brown fox jumps over it"),
]
SCHEMA = "doc_id long, text string, n_lines int, source string, lang string, token_ids int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, 1, None if d == 4 else "s", "en", 3) for d, t in TEXTS], SCHEMA)


def line_brute(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\r\x0b\x0c").translate(low)
    held = {}
    for i, (d, t) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            held.setdefault(k, []).append((-1 if d is None else d, i))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        gone = [len(key(x)) >= 20 and len(held[key(x)]) >= 3 and max(held[key(x)])[0] != (-1 if d is None else d) for x in lines]
        out.append((d, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_line_dedup(docs, limit):
    got = line_dedup.line_dedup(docs, broadcast_bytes=limit).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, line_brute(TEXTS)))


def test_mph_is_minimal_and_perfect():
    import numpy as np

    h = np.unique(np.random.default_rng(0).integers(0, 2**63, 20_000).astype(np.uint64))
    assert sorted(line_dedup.look_up(line_dedup.build_mph(h, h), h, h).tolist()) == list(range(len(h)))


def test_bpe_equals_tiktoken(docs):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.bpe_decode(bpe.bpe_encode(docs, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert r.token_ids == own.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def brute_fp(text):
    import xxhash

    low = bytes(text or "", "utf-8").lower()
    w = [x for x in re.split(rb"[\x20\x09-\x0D]+", low) if x]
    sh = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hs = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash(docs):
    got = {(r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.simhash_near_dedup(docs.filter("doc_id is not null")).collect()}
    fps = {d: brute_fp(t) for d, t in TEXTS if d}
    comp = {d: d for d in fps}
    for _ in fps:
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 4:
                    comp[a] = comp[b] = min(comp[a], comp[b])
    assert got == {(d, fps[d], comp[d]) for d in fps}


def test_golay_pairs_find_every_link(spark):
    import random

    rng, links, fps = random.Random(1), set(), set()
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << k
        fps |= {a, b}
        links.add((a, b))
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    e = simhash.verified(simhash.fuzzy_keys(spark.createDataFrame([(signed(x),) for x in fps], "fp long")), 4)
    from tests.llm.test_rows import groups

    found = groups({signed(x) for x in fps}, [(r.a, r.b) for r in e.collect()])
    of = {x: k for k, g in enumerate(found) for x in g}
    assert all(of[signed(a)] == of[signed(b)] for a, b in links)


def pii_brute(t):
    spans = []
    luhn = lambda s: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    for kind, p, ok in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ):
        spans += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(p, t or "") if ok(m.group())]
    return spans


def test_pii_base(docs, spark):
    x = pii.find_pii(docs).select("doc_id", pii.span_text(*pii.KINDS).alias("s"), pii.span_text("secret").alias("x")).collect()
    assert sorted((str(r.doc_id), r.s) for r in x) == sorted((str(d), ",".join(pii_brute(t))) for d, t in TEXTS)
    assert all(("secret" in r.x) == (r.doc_id == 6) for r in x)


def test_pii_base_on_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: ",".join(pii_brute(r.text)) for r in d.collect()}
    assert {r.doc_id: r.s for r in pii.find_pii(d).select("doc_id", pii.span_text(*pii.KINDS).alias("s")).collect()} == want


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    lab = spark.read.parquet(f"{d}/labels.parquet")
    x = quality.quality_scores(spark.read.parquet(f"{d}/documents.parquet"), lab).join(lab, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in x) / len(x) > 0.9
    assert all(0 <= r.score <= 1 for r in x)


def test_quality_without_labels(docs, spark):
    x = quality.quality_scores(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert len(x) == len(TEXTS) and all(r.score == 0.5 for r in x)


def test_mixing_probabilities(docs):
    x = mixing.mix_to_targets(docs).collect()
    assert len(x) == len(TEXTS) and all(0 <= r.probability <= 1 for r in x)


def test_mixing_meets_marginals(spark):
    import itertools

    cells = spark.createDataFrame([(s, lang, t, 10 + 7 * i) for i, (s, lang, t) in enumerate(itertools.product("ab", "xyz", "uv"))], "source string, lang string, topic string, n long")
    rows = mixing.rake(cells, 0.5, 12).collect()
    for d in mixing.DIMS:
        for v in {r[d] for r in rows}:
            mine = [r for r in rows if r[d] == v]
            assert abs(sum(r.w for r in mine) - mine[0][f"t_{d}"]) < 1e-6


def test_licenses(docs):
    assert [(r.doc_id, r.license) for r in licenses.license_scan(docs).collect()] == [(9, "MIT")]


def test_chat(spark):
    t = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, None, "x"), (None, 1, "a", "b")], "conv_id long, turn long, role string, text string")
    x = chat.rotate_perspectives(t).collect()
    assert len(x) == 3 * 4 and sum(r.loss_start is not None for r in x) == 3


def test_vectors(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    a = rng.normal(size=(60, 16))
    a[30:50] = a[:20] + 0.12 * rng.normal(size=(20, 16))
    a[50:] = a[0]
    rows = [(i, a[i].tolist(), i % 2 if i < 30 else (i - 30) % 2 if i < 50 else 0) for i in range(60)]
    rows += [(100, None, 0), (101, [0.0] * 16, 0), (102, [float("nan")] * 16, 0), (103, a[0].tolist(), None)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    n = np.zeros(60, int)
    comp = list(range(60))
    u = a / np.linalg.norm(a, axis=1)[:, None]
    near = [(i, j) for i in range(60) for j in range(60) if i != j and rows[i][2] == rows[j][2] and u[i] @ u[j] >= 0.93]
    for i, _ in near:
        n[i] += 1
    for _ in range(60):
        for i, j in near:
            comp[i] = comp[j] = min(comp[i], comp[j])
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.embedding_near_dedup(v, block=8).collect()}
    assert got == {i: (n[i], comp[i]) for i in range(60)} | {i: (0, i) for i in (100, 101, 102, 103)}
    found = {}
    for r in vectors.hilbert_neighbours(v, v.filter("vec_id % 10 = 0"), k=5, block=8).collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    b = np.concatenate([a, a[:1]])
    ids, hit = [*range(60), 103], 0
    for q, got in found.items():
        d = np.sqrt(((b - a[q]) ** 2).sum(1))
        want = [i for _, i in sorted((x, i) for x, i in zip(d, ids) if i != q)][:5]
        hit += len(set(want) & set(got))
    assert set(found) == {0, 10, 20, 30, 40, 50} and hit >= 0.9 * 30


def test_empty_tables(spark):
    d = spark.createDataFrame([], SCHEMA)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    v = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for x in (line_dedup.line_dedup(d), simhash.simhash_near_dedup(d), mixing.mix_to_targets(d), pii.find_pii(d), licenses.license_scan(d), bpe.bpe_encode(d, path, public_tokenizers.PATTERN), vectors.embedding_near_dedup(v), vectors.hilbert_neighbours(v, v)):
        assert x.count() == 0
    assert hashlib.sha256(b"").hexdigest()


def test_chat_long_dialogue(spark):
    """Offsets run on over stretches; null, negative and repeated turns included."""
    from cadenza.llm.chat import rotate_perspectives

    rows = [(1, i, "ab c"[i % 4] if i % 7 else None, "x" * (i % 11)) for i in range(-70, 200)] + [(1, None, "a", "y"), (1, 3, "a", "z"), (1, 3, "a", "z"), (2, 0, "a", None)]
    got = rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    for conv, me in {(r.conv_id, r.perspective) for r in got}:
        mine = sorted((r for r in got if (r.conv_id, r.perspective) == (conv, me)), key=lambda r: r.position)
        turns = sorted((-1 if t is None else t, w or "unknown", x or "") for c, t, w, x in rows if c == conv)
        at = 0
        assert [r.position for r in mine] == list(range(1, len(turns) + 1))
        for r, (t, w, x) in zip(mine, turns):
            head = "<|assistant|>\n" if w == me else f"<|user name={w}|>\n"
            assert (r.turn, r.rendered, r.char_start) == (t, head + x + "<|end|>\n", at)
            at += len(r.rendered)
            assert r.char_end == at and r.loss_start == (r.char_start + len(head) if w == me else None)


def test_mixing_sql(spark):
    import duckdb

    from cadenza.llm import queries

    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet')")
    o = c.execute(queries.ORACLES["op3_mixing_targets"])
    cols = [x[0] for x in o.description]
    df = queries.op3_mixing_targets(spark, d)
    assert sorted(cols) == sorted(df.columns)
    key = lambda r: tuple(str(round(v, 7) if isinstance(v, float) else v) for v in r)
    assert sorted(map(key, df.select(*cols).collect())) == sorted(map(key, o.fetchall()))
