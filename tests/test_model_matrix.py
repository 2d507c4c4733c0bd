"""The matrix of models and metrics holds every clip and every metric."""
from cadenza.plans.catalog import QUERIES, wide

D = "/root/testdata/sf0.001"


def test_matrix_is_whole(spark):
    clips = {r[0] for r in spark.read.parquet(f"{D}/events.parquet").select("event_type").distinct().collect()}
    long = QUERIES["metrics_long"](spark, D)
    x = wide(long)
    assert set(x.columns) == {"metric"} | clips and {"error", "signup"} <= clips
    want = {(r.clip_id, r.metric): r.value for r in long.collect()}
    assert {(c, r.metric): r[c] for r in x.collect() for c in clips} == want
    assert {(r.clip_id, r.metric): r.value for r in QUERIES["model_matrix"](spark, D).collect()} == want
    assert {m for _, m in want} == {"smoothness", "flicker", "p95"}
