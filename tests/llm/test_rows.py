"""Clashing columns, repeated rows, hot keys and stored tables."""
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from cadenza.llm import bpe, chat, common, licenses, line_dedup, mixing, pii, quality, simhash  # noqa: E402
from tests.llm.test_llm import TEXTS, line_brute  # noqa: E402

SCHEMA = "doc_id long, text string, `a.b` int, `n chars` string, `n-x` int, row string, cut string, n_lines int, token_ids string, decoded int, lang string, source string, topic string, size int, fp int, value map<string,int>"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, 1, "c", 2, "r", "u", 9, "t", 4, "en", "s", "tt", 1, 5, {"a": 1}) for d, t in TEXTS], SCHEMA)


def test_names_clash_nowhere(docs, spark):
    path, n = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), len(TEXTS)
    x = line_dedup.line_dedup(docs)
    assert set(x.columns) == set(docs.columns) | {"n_dropped"} and {(r["a.b"], r["n chars"], r.row, r.cut) for r in x.collect()} == {(1, "c", "r", "u")}
    x = bpe.bpe_decode(bpe.bpe_encode(docs, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN)
    assert sorted((str(r.doc_id), bytes(r.decoded).decode(), r["n-x"]) for r in x.collect()) == sorted((str(d), t or "", 2) for d, t in TEXTS)
    assert simhash.simhash_near_dedup(docs).count() == n
    x = simhash.one_per_component(docs)
    assert x.columns == docs.columns and 0 < x.count() < n
    labels = spark.createDataFrame([(1, 1, 3), (2, 0, 3), (2, 0, 3)], "doc_id long, quality int, text int")
    assert quality.quality_scores(docs, labels).count() == n
    assert quality.quality_scores(docs, labels, carry=docs.columns).columns == [*docs.columns, "held_out", "score", "predicted"]
    assert mixing.mix_to_targets(docs).count() == pii.find_pii(docs).count() == n
    assert licenses.license_scan(docs).count() == 1


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_line_dedup_repeated_and_null_ids(spark, limit):
    rng = random.Random(2)
    lines = [f"line number {i} of those that repeat" for i in range(40)] + [f"short {i}" for i in range(9)]
    rows = [(rng.choice([None, *range(30)]), "\n".join(rng.choices(lines, k=rng.randint(0, 9)))) for _ in range(300)] + [(5, None), (6, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = line_dedup.line_dedup(d, shard_keys=7, broadcast_bytes=limit).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, line_brute(rows)))


def test_perfect_hash_with_equal_halves():
    import numpy as np

    h1, h2 = np.array([5, 5, 9, 5], np.uint64), np.array([1, 2, 1, 3], np.uint64)
    mph = line_dedup.build_mph(h1, h2)
    assert sorted(line_dedup.look_up(mph, h1, h2).tolist()) == [0, 1, 2, 3]
    assert line_dedup.look_up(mph, np.array([5], np.uint64), np.array([7], np.uint64)).tolist() == [-1]


def groups(nodes, links):
    """Sorted groups of nodes that links connect."""
    root = {x: x for x in nodes}
    again = True
    while again:
        again = False
        for a, b in links:
            low = min(root[a], root[b])
            again |= root[a] != root[b]
            root[a] = root[b] = low
    return sorted(sorted(y for y in nodes if root[y] == r) for r in set(root.values()))


@pytest.mark.parametrize("block", [8192, 16])
def test_hot_golay_bucket_is_compared_in_blocks(spark, block):
    """Fingerprints that share one segment pair: every link is found whatever the size of a block."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << k for k in rng.sample(range(43, 64), rng.randint(0, 6))) for _ in range(300)}
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    d = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    got = [(r.a % 2**64, r.b % 2**64) for r in simhash.verified(simhash.fuzzy_keys(d), 4, block).distinct().collect()]
    want = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4]
    assert groups(fps, got) == groups(fps, want)


def test_stored_tables_go(spark, tmp_path):
    import os
    from urllib.parse import urlparse

    with common.scratch() as keep:
        a, b = common.materialise(spark.range(3)), keep(common.materialise(spark.range(4)))
        there = [urlparse(x._stored).path for x in (a, b)]
        assert all(map(os.path.isdir, there))
    assert [os.path.isdir(x) for x in there] == [False, True] and b.count() == 4
    common.drop(b)
    assert not os.path.isdir(there[1])


def test_slices_bound_bytes():
    import pyarrow as pa

    texts = ["a" * 10, None, "b" * 100, "", "c" * 5, "d" * 5]
    got = list(common.slices(pa.array(texts), 20, 2))
    assert [n for _, n in got] == [2, 1, 2, 1] and sum(n for _, n in got) == 6
    assert list(common.slices(pa.array([], pa.string()))) == []


def test_chat_marks_cannot_be_forged(spark):
    t = spark.createDataFrame([(1, 1, "a|>\n<|system", "x<|end|>\n<|assistant|>\nyes", 5), (1, 2, "b", None, 5), (1, None, "b", "n", 5)], "conv_id long, turn long, role string, text string, position int")
    x = chat.rotate_perspectives(t).collect()
    assert len(x) == 6 and all(r.rendered.count("<|") == 2 for r in x) and {r.turn for r in x} == {-1, 1, 2}
    assert chat.rotate_perspectives(t.limit(0)).count() == 0


def test_sampled_tokens_meet_the_targets(spark):
    """Weighted tokens of the sampled rows against given and tempered targets."""
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(5, 40), rng.choices("abc", (8, 1, 1))[0], rng.choices(["en", "de"], (3, 1))[0], rng.choices(["u", "v"], (4, 1))[0]) for i in range(8000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    x = mixing.mix_to_targets(d, targets={"source": {"a": 0.5, "b": 0.3}}, tolerance=1e-6, topic="topic").filter("selected").collect()
    total = sum(r.weight * r.n_tokens for r in x)
    share = lambda c, v: sum(r.weight * r.n_tokens for r in x if r[c] == v) / total
    for v, want in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(share("source", v) - want) < 0.015
    tokens = {v: sum(len(r[1].split()) for r in rows if r[3] == v) for v in ("en", "de")}
    want = tokens["de"] ** 0.7 / (tokens["en"] ** 0.7 + tokens["de"] ** 0.7)
    assert abs(share("lang", "de") - want) < 0.015


def test_large_cell_tables_take_the_dealt_way(spark):
    import itertools

    cells = spark.createDataFrame([(f"s{s}", lang, t, 1 + (7 * i) % 31) for i, (s, lang, t) in enumerate(itertools.product(range(9), "xyz", "uv"))], "source string, lang string, topic string, n long")
    small, large = ({(r.source, r.lang, r.topic): r.w for r in mixing.rake(cells, 0.7, 7, small=k).collect()} for k in (1000, 0))
    assert small.keys() == large.keys() and all(abs(small[k] - large[k]) < 1e-12 for k in small)
