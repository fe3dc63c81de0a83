"""Session defaults. Library code never changes a running session's settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot leaves methods above 8000 bytes uncompiled, so plans that would
    # generate such a method are better run stage by stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    # Call-site capture for every column expression makes plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sheafline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for ``name`` below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only a local session without
    that setting falls back to a temporary folder of the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; a cluster needs a shared folder")
        base = tempfile.mkdtemp(prefix="sheafline-")
    return f"{base.rstrip('/')}/{name}-{os.urandom(6).hex()}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a costly intermediate table once to the shared folder and read it back.

    Later reads are plain scans with a lineage of their own, so a lost executor
    does not bring the work before it back.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
