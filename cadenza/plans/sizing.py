"""How many tasks and which chunk a job gets, as column expressions over a table of jobs."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.scalars import clamp
from cadenza.session import table


def whole(x):
    return F.floor(x).cast("long")


def allocate(jobs: DataFrame) -> DataFrame:
    """jobs(job_id, total_frames, width, height, cpus, ram_gb, workers, chunk_size, ratio) -> (job_id, n_workers, chunk_size, n_chunks).

    workers, chunk_size: null where the job leaves them open; then `ratio` of the cores, four at most, take two
    chunks each, of 50 to 1,500 frames, or as many as `ratio` of the memory holds. Cards are the cluster's
    own: see models.task_profile().
    """
    c = F.col
    x = jobs.withColumn("ratio", clamp(c("ratio"), 0.50, 0.70))
    free = F.least(F.lit(4), F.greatest(F.lit(1), whole(c("cpus") * c("ratio"))))
    x = x.withColumn("n_workers", F.when(c("workers") > 0, c("workers")).otherwise(free).cast("long"))
    n, w = c("total_frames"), c("n_workers")
    least = clamp(whole(n / w), 50, 200)
    size = F.greatest(least, clamp(F.ceil(n / (w * 2)), 50, 1500))
    bound = whole(c("ram_gb") * 1024**3 * c("ratio") / (w * c("width") * c("height") * 3))
    size = F.when(c("chunk_size") > 0, c("chunk_size")).otherwise(F.when(bound < size, F.greatest(F.lit(50), bound)).otherwise(size))
    x = x.withColumn("chunk_size", size.cast("long"))
    return x.select("job_id", "n_workers", "chunk_size", F.ceil(n / F.greatest(F.lit(1), c("chunk_size"))).alias("n_chunks"))


def cpu_sizing(spark, sf_dir):
    """Orders as jobs: workers and chunks by cores, frames and memory."""
    o, none = table(spark, sf_dir, "orders"), F.lit(None).cast("int")
    jobs = o.select(F.col("o_orderkey").alias("job_id"), (F.col("o_custkey") * 40).alias("total_frames"), F.lit(1920).alias("width"), F.lit(1080).alias("height"),
                    (F.col("o_orderkey") % 16 + 1).cast("int").alias("cpus"), (F.col("o_orderkey") % 9 + 1).cast("double").alias("ram_gb"), none.alias("workers"), none.alias("chunk_size"), F.lit(0.65).alias("ratio"))
    return allocate(jobs).select("job_id", F.col("n_workers").cast("long"), "chunk_size", F.col("n_chunks").cast("long"))


QUERIES = {"cpu_sizing": cpu_sizing}
ORACLES = {
    "cpu_sizing": """WITH j AS (SELECT o_orderkey AS job_id, o_custkey * 40 AS n, least(4, greatest(1, CAST(floor((o_orderkey % 16 + 1) * 0.65::DOUBLE) AS BIGINT))) AS w, o_orderkey % 9 + 1 AS gb FROM orders),
k AS (SELECT *, greatest(least(200, greatest(50, n // w)), least(1500, greatest(50, CAST(ceil(n / (2.0 * w)) AS BIGINT)))) AS want, CAST(floor(gb * 1073741824 * 0.65::DOUBLE / (w * 6220800)) AS BIGINT) AS fits FROM j),
s AS (SELECT *, CASE WHEN fits < want THEN greatest(50, fits) ELSE want END AS size FROM k)
SELECT job_id, w AS n_workers, CAST(size AS BIGINT) AS chunk_size, CAST(ceil(n / size::DOUBLE) AS BIGINT) AS n_chunks FROM s""",
}
