"""Features of the quality classifier."""
import pytest

from cadenza.llm import quality


@pytest.mark.parametrize("word", ["слово", "λόγος", "كلمة", "漢字", "word", "été", "ªº×÷²½", "12#"])
def test_letters_do_not_depend_on_length(word):
    short, long = (f"{word} " * 10).strip(), (f"{word} " * 900).strip()
    for t in (short, long):
        assert quality.features(t)[4] == sum(map(str.isalpha, t)) / len(t)
    lines = quality.features("\n".join([long, long]))
    assert lines[9] == quality.features(long)[4]


def test_letters_equal_isalpha():
    every = "".join(map(chr, range(0x110000)))
    assert quality.n_letters(every) == sum(map(str.isalpha, every))
    assert quality.n_letters("") == 0


def test_a_repeated_labelled_document_cannot_exceed_the_bound(spark):
    rows = [(7, f"line {i} of many words that repeat")  for i in range(900)] + [(i, "Words of a text.") for i in range(20, 60)]
    labels = spark.createDataFrame([(7, 1)] + [(i, i % 2) for i in range(20, 60)], "doc_id long, quality int")
    seen, own = [], quality.fit
    try:
        quality.fit = lambda x, y, pairs: seen.append(len(x)) or own(x, y, pairs, steps=3)
        out = quality.quality_scores(spark.createDataFrame(rows, "doc_id long, text string"), labels, max_train=50, pairs=100)
    finally:
        quality.fit = own
    assert seen == [50] and out.count() == len(rows)
