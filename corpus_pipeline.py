"""Corpus pipeline: quality, line dedup, SimHash near-dedup, mixing, BPE; each stage is stored.

Each stage decides on a row itself, not by its doc_id, which may be null.
"""
import functools

from pyspark.sql import functions as F

from cadenza.llm import bpe, common, line_dedup, mixing, quality, simhash

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: What decides a row's fate in mixing: rows without a doc_id go by their text, or all would share one fate.
KEY = "coalesce(CAST(doc_id AS STRING), md5(CAST(coalesce(text, '') AS BINARY)))"


def _bounded(stage):
    """The stage, in a session whose Arrow batches are bounded by bytes."""

    @functools.wraps(stage)
    def run(spark, docs, sf_dir):
        common.bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


@_bounded
def quality_stage(spark, docs, sf_dir):
    """Drops documents that the classifier predicts as 0."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.quality_scores(docs, labels, carry=COLUMNS).filter("predicted = 1").select(*COLUMNS)


@_bounded
def line_stage(spark, docs, sf_dir):
    """Cuts repeated lines; n_chars follows the text."""
    return line_dedup.line_dedup(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@_bounded
def simhash_stage(spark, docs, sf_dir):
    """Keeps one row of each group, that of the smallest doc_id; null is the largest."""
    return simhash.one_per_component(docs.select(*COLUMNS))


def mixing_stage(spark, docs, sf_dir):
    """Samples the cells above their target; `weight` brings the tokens of the others up to theirs."""
    return mixing.mix_to_targets(docs, tolerance=1e-6, key=KEY, carry=COLUMNS).filter("selected").select("row.*", "weight")


@_bounded
def bpe_stage(spark, docs, sf_dir):
    """Adds token ids; the text is what they decode to. The weight of mixing stays."""
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    weight = [c for c in docs.columns if c == "weight"]
    x = bpe.bpe_decode(bpe.bpe_encode(docs.select(*COLUMNS, *weight), path, P.PATTERN), path, P.PATTERN)
    return x.select("doc_id", F.col("decoded").cast("string").alias("text"), "lang", "source", "n_chars", *weight, "token_ids", F.size("token_ids").cast("long").alias("n_tokens"))


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("simhash_near_dedup", simhash_stage), ("mixing", mixing_stage), ("byte_bpe", bpe_stage)]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        with common.scratch() as keep:  # what a stage stored on its way goes when its rows are written
            done = keep(common.materialise(stage(spark, docs, sf_dir)))
        common.drop(docs)
        docs = done
    return docs
