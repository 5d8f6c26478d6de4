"""Session settings the operators rely on, and the staging helper."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("sensorlab")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; in local mode one of our own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="sensorlab-", dir=os.environ.get("TMPDIR", "/tmp")))
    return context.getCheckpointDir()


def stage(df: DataFrame) -> DataFrame:
    """Cut the lineage: written as Parquet in the shared folder and read back, so later reads prune columns and know sizes."""
    path = scratch(df.sparkSession, "stage")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
