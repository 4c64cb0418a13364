"""Session defaults and the few helpers that every layer shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kelpforge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables under ``sf_dir``; the path goes to Spark's own reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where that setting is absent (a local session) a temporary folder is made.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="kelpforge-")
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir()
    return found


def materialize(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read, not a recomputation,
    and gives the optimizer the real size of an intermediate result.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kelpforge/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
