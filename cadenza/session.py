"""Session factory and table loaders."""
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str = "local[*]", conf: dict | None = None) -> SparkSession:
    base = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": "8",
        "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    }
    s = SparkSession.builder.master(master).appName("cadenza").config(map=base | (conf or {})).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set, only a local master may do without."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return path or "file:///tmp/cadenza-checkpoints"


def stored(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: what follows does not compute it again. The copy goes when the driver ends."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, kind: str = "cadenza") -> str:
    """A new path in the shared folder; what lies there is deleted when the driver ends."""
    folder = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return f"{folder}/rows"
