"""What plans share: tables of a folder, checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STAR = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, where a table has too few files for them (small tables); else as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df._jdf.toJavaRDD().getNumPartitions() <= cores else df


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; one of this machine only where none is set and all runs here, as in tests."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared checkpoint folder and cuts the lineage there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
