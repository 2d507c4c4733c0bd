"""Vector codes, decontamination and source divergence against plain versions, on small and awkward rows."""
import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from cadenza.llm import codes, decontaminate, divergence

# -- vector codes ----------------------------------------------------------------------------------------


def plain_nearest(q, book):
    d = ((q[:, None] - book[None]) ** 2).sum(-1)
    return d.argmin(1), d.min(1)


@pytest.mark.parametrize("spread, n, width", [(2, 300, 3), (900, 256, 16), (5, 1, 2), (1 << 26, 40, 4)])
def test_branch_and_bound_is_exact_and_ties_go_low(spread, n, width):
    rng = np.random.default_rng(n)
    book, q = rng.integers(-spread, spread, (n, width)), rng.integers(-spread, spread, (700, width))
    book[n // 2 :] = book[: n - n // 2]  # every entry twice
    at, far = codes.search(codes.kd_tree(book), book, q)
    want = plain_nearest(q, book)
    assert (at == want[0]).all() and (far == want[1]).all()


def plain_codes(rows, parts=4, entries=256, rounds=4):
    fine = sorted((i is None, i or 0, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v))
    size = len(fine[0][2]) if fine else 0
    fine = [r for r in fine if len(r[2]) == size and size % parts == 0]
    x = [[[math.floor(1024 * np.float64(np.float32(c))) for c in v[p * size // parts : (p + 1) * size // parts]] for p in range(parts)] for _, _, v, _ in fine]
    books = [[list(r[p]) for r in x[:entries]] for p in range(parts)]

    def nearest(c, book):
        return min((sum((a - b) ** 2 for a, b in zip(c, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = collections.defaultdict(list)
            for r in x:
                held[nearest(r[p], books[p])[1]].append(r[p])
            for k, v in held.items():
                books[p][k] = [sum(c) // len(v) for c in zip(*v)]
    found = [[nearest(r[p], books[p]) for p in range(parts)] for r in x]
    total = collections.Counter()
    for (_, _, _, label), f in zip(fine, found):
        total[label] += sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted((None if none else i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), total[label], digest) for (none, i, _, label), f in zip(fine, found))


SCHEMA = "vec_id long, embedding array<float>, label int, error string, code int"


def test_codes_equal_a_plain_version(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.3, rng.uniform(-1, 1)]) for _ in range(8)], rng.choice([None, 1, 2])) for i in range(90)]
    rows += [(200 + i, [0.125] * 8, 1) for i in range(60)]  # a hot vector
    rows += [(7, [0.5] * 8, 3), (300, None, 1), (301, [], 1), (302, [None] * 8, 1), (303, [float("nan")] + [0.0] * 7, 1), (304, [float("inf")] * 8, 1), (305, [0.1] * 4, 1), (306, [0.0] * 8, None)]
    d = spark.createDataFrame([(*r, "e", 1) for r in rows], SCHEMA).repartition(5)
    got = codes.compress(d, entries=16)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == plain_codes(rows, entries=16)


def test_codes_of_nothing_and_of_odd_lengths(spark):
    assert codes.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    assert codes.compress(spark.createDataFrame([(1, [1.0] * 6, 1, "", 1)], SCHEMA)).count() == 0
    one = codes.compress(spark.createDataFrame([(1, [1.0, 2.0, -0.0001, 4.0], None, "", 1), (None, [1.0, 2.0, -0.0001, 4.0], None, "", 1)], SCHEMA)).collect()
    assert [(r.code, r.error, r.label_error) for r in one] == [("00000000", 0, 0)] * 2
    assert one[0].codebooks_sha256 == hashlib.sha256(b"1024,1024,2048,2048,-1,-1,4096,4096").hexdigest()


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 8)).astype(np.float32)
    d = spark.createDataFrame([(i, x.tolist(), 0, "", 0) for i, x in enumerate(v)], SCHEMA)
    books = codes.train_codebooks(codes.codable(d)[0], entries=32)
    coded = {r.vec_id: r for r in codes.encode(d, books).collect()}
    for r in codes.decode(codes.encode(d, books), books).collect():
        x = np.floor(v[r.vec_id].astype(float) * 1024)
        assert ((x - np.array(r.embedding) * 1024) ** 2).sum() == coded[r.vec_id].error


# -- decontamination -------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_contamination(docs, items, window):
    held = collections.defaultdict(set)
    for i, t in items:
        w = WORD.findall((t or "").translate(LOW))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            held[tuple(w[k : k + window])].add(i)
    out = []
    for d, t in docs:
        w, hit, ids = WORD.findall((t or "").translate(LOW)), set(), set()
        for n in {len(k) for k in held}:
            for k in range(len(w) - n + 1):
                if (key := tuple(w[k : k + n])) in held:
                    hit |= set(range(k, k + n))
                    ids |= {str(i) for i in held[key] if i is not None}
        out.append((d, len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("part_bytes", [2 << 20, 60])
def test_contamination_equals_a_plain_version(spark, part_bytes):
    rng = random.Random(6)
    words = ["Ünder", "42", "ABC", "de", "été", "x", "ñ", "日本"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "-", ".\t", "\x00"]) for _ in range(n))
    items = [(rng.choice([None, *range(12)]), text(rng.randint(0, 9))) for _ in range(14)] + [(5, None), (6, ""), (7, " .-")]
    docs = [(rng.choice([None, *range(40)]), text(rng.randint(0, 30)) + (rng.choice(items)[1] or "").upper()) for _ in range(60)]
    docs += [(1, None), (2, ""), (3, "..."), (3, "...")]
    d = spark.createDataFrame([(*r, 9, "z") for r in docs], "doc_id long, text string, n_hit int, `a.b` string").repartition(3)
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    got = decontaminate.find_contamination(d, b, window=4, part_bytes=part_bytes, carry=d.columns).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got], key=str) == plain_contamination(docs, items, 4)
    assert {r["a.b"] for r in got} == {"z"}
    for r in got:  # spans lie at words of the original and hold as many as were hit
        assert sum(len(WORD.findall(r.text[s.start : s.end].translate(LOW))) for s in r.spans) == r.n_hit
        assert all(WORD.match(r.text[s.start].translate(LOW)) and (s.start == 0 or not WORD.match(r.text[s.start - 1].translate(LOW))) for s in r.spans)


def test_contamination_across_the_cuts_of_a_long_text(spark):
    item = "one two three four five six seven eight nine ten eleven"
    text = "y" * 10 + (" pad" * 20 + " " + item) * 120_000 + " " + "z" * 5_000_000
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = decontaminate.find_contamination(d, spark.createDataFrame([(3, item)], "item_id long, text string")).first()
    assert (r.n_words, r.n_hit, r["items"], len(r.spans)) == (120_000 * 31 + 2, 120_000 * 11, ["3"], 120_000)


def test_contamination_of_and_by_nothing(spark):
    d, b = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.find_contamination(d, b).collect()] == [(1, 2, 0, [], [], False)]
    assert decontaminate.find_contamination(d.limit(0), b).count() == 0


# -- source divergence -----------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(rows, top):
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    docs, n = collections.Counter(), collections.Counter()
    for t, lang, s in rows:
        found = TERM.findall(t.translate(LOW))
        docs.update({(lang, w) for w in found})
        n.update((lang, s, w) for w in found)
    out = []
    for lang in {r[1] for r in rows}:
        kept = sorted(w for (k, w), c in docs.items() if k == lang and c >= 3)
        sources = sorted({r[2] for r in rows if r[1] == lang})
        count = {s: [n[lang, s, w] for w in kept] for s in sources}
        every = [sum(c) for c in zip(*count.values())]
        share = lambda c: [1 + 10**9 * (x + 1) // (sum(c) + len(kept)) for x in c]  # noqa: B023, E731
        p, q = {s: share(c) for s, c in count.items()}, share(every)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pair = [(o, sum(map(f, p[s], p[o]))) for o in sources if o != s]
            term = [(w, f(a, b)) for w, c, a, b in zip(kept, count[s], p[s], q) if c > 0 and a > b]
            for part, held in (("pair", pair), ("term", term)):
                ranked = sorted(held, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, *x, k + 1) for k, x in enumerate(ranked) if part == "pair" or k < top]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [7, 100_000])
def test_divergence_equals_a_plain_version(spark, shard_rows):
    rng = random.Random(8)
    words = ["été", "Word", "a1b", "ñandú", "日本", "tail", "o'x", "zz"]
    rows = [(rng.choice([None, "", " ".join(rng.choices(words, k=rng.randint(1, 30)))]), rng.choice([None, "en", "d'e"]), rng.choice(["s0", "s0", "s1", None, "ß"])) for _ in range(80)]
    rows += [("alone", "xx", "s9"), (None, "xx", "s8"), ("hot " * 500, "en", "s0")]
    d = spark.createDataFrame([(*r, "v", 1) for r in rows], "text string, lang string, source string, term string, n int").repartition(4)
    got = divergence.source_divergence(d, top=4, shard_rows=shard_rows, least_shards=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain_divergence(rows, 4)


def test_divergence_of_nothing_and_of_long_texts(spark):
    schema = "text string, lang string, source string"
    assert divergence.source_divergence(spark.createDataFrame([], schema)).count() == 0
    rows = [("word other " * 600_000, "en", "a"), ("word " + "q" * 5_000_000, "en", "b"), ("other word", "en", "b"), ("other", "en", "a")]
    assert sorted(map(tuple, divergence.source_divergence(spark.createDataFrame(rows, schema)).collect())) == plain_divergence(rows, 200)


def test_counts_are_flushed_without_loss():
    import pyarrow as pa

    rows = [(" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(i, i + 300)), "en", "s") for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["text", "lang", "source"])
    total = collections.Counter()
    for b in divergence._term_counts(iter([batch] * 5), most=400):
        for r in b.to_pylist():
            total[r["term"]] += r["docs"]
    want = collections.Counter(w for t, _, _ in rows for w in set(t.split()) for _ in range(5))
    assert total.pop(None) == 200 and total == want
