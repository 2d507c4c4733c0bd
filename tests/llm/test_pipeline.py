"""Stages of the corpus pipeline on rows with null, repeated and reused doc_ids."""
import random

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline as P  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], SCHEMA)


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(n))


def keys(df):
    return sorted((str(r.doc_id), r.text) for r in df.collect())


def test_quality_stage_judges_rows(spark, tmp_path):
    clean, junk = [prose(80, i) for i in range(60)], ["#$% BUY NOW NOW NOW " * 20 + str(i) for i in range(60)]
    rows = [(i, t, "a") for i, t in enumerate(clean + junk)]
    spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    nulls = [(None, prose(80, 900), "a"), (None, prose(80, 901), "a"), (None, junk[0] + "!", "a")]
    reused = [(3, junk[1] + "?", "a")]
    got = keys(P.quality_stage(spark, frame(spark, rows + nulls + reused), str(tmp_path)))
    assert got == sorted((str(d), t) for d, t, _ in rows[:60] + nulls[:2])


def test_line_stage_keeps_null_ids(spark):
    line = "the same long line stands in every document"
    got = keys(P.line_stage(spark, frame(spark, [(None, f"{line}\none", "a"), (None, f"{line}\ntwo", "a"), (1, f"{line}\nthree", "a")]), ""))
    assert got == [("1", f"{line}\nthree"), ("None", "one"), ("None", "two")]


def test_mixing_stage_keeps_null_ids(spark):
    rows = [(None if i % 2 else i, prose(50, i), "a" if i % 10 else "b") for i in range(400)]
    got = P.mixing_stage(spark, frame(spark, rows), "").collect()
    n = sum(r.doc_id is None for r in got)
    assert all(r.doc_id is None or r.source in "ab" for r in got)
    assert sum(d is None for d, _, _ in rows) * 0.8 < n < sum(d is None for d, _, _ in rows)
    assert {r.source for r in got} == {"a", "b"}


def test_bpe_stage_keeps_null_ids(spark):
    got = P.bpe_stage(spark, frame(spark, [(None, "one two", "a"), (None, None, "a"), (1, "three", "a")]), "").collect()
    assert sorted((str(r.doc_id), r.text, r.n_tokens > 0) for r in got) == [("1", "three", True), ("None", "", False), ("None", "one two", True)]


def test_simhash_stage_keeps_one_row_a_group(spark):
    a, b, c, d = (prose(60, i) for i in range(4))
    rows = [(7, a, "a")] * 3  # repeated rows
    rows += [(1, b, "a"), (5, b, "a"), (5, c, "a")]  # doc 5 copies doc 1, and another row of it stands alone
    rows += [(None, d, "a"), (None, d, "a"), (None, d.upper(), "a")]  # a group without ids
    rows += [(None, a, "b"), (None, None, "a"), (None, "", "a")]  # a copy without an id; no words
    got = keys(P.simhash_stage(spark, frame(spark, rows).repartition(5), ""))
    assert sorted((i, (t or "").lower()) for i, t in got) == sorted([("7", a), ("1", b), ("5", c), ("None", d), ("None", "")])


def test_kept_weights_meet_the_targets(spark):
    rows = [(i, prose(50, i), "a" if i % 10 else "b") for i in range(2000)]
    got = P.bpe_stage(spark, P.mixing_stage(spark, frame(spark, rows), ""), "").collect()
    mass = {s: sum(r.weight * len(r.text.split()) for r in got if r.source == s) for s in "ab"}
    target = 0.1**0.7 / (0.1**0.7 + 0.9**0.7)
    assert abs(mass["b"] / (mass["a"] + mass["b"]) - target) < 0.01
    assert {r.doc_id for r in got if r.source == "b"} == set(range(0, 2000, 10))
