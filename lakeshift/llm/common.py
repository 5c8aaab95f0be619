"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters that separate words.
ASCII_SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, where a table has too few files for them (small tables); else as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df._jdf.toJavaRDD().getNumPartitions() <= cores else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches by rows: texts are long, so that the default of 10,000 rows could be gigabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; one of this machine only where none is set and all runs here, as in tests."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith(("local[", "local-cluster")) and context.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Writes the rows to the cluster's shared checkpoint folder and cuts the lineage there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def row_place(df: DataFrame) -> Column | None:
    """A hash of each row's file and its number there, the same whenever it is read; None if rows don't come straight from files."""
    hidden = df._jdf.queryExecution().analyzed().metadataOutput().mkString(",")
    return F.xxhash64("_metadata.file_path", "_metadata.row_index") if "_metadata#" in hidden else None


def ascii_lower(text: Column) -> Column:
    """A-Z alone; lower() would change other letters too, but is right and much faster for ASCII texts."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def wide_hash(*columns: Column) -> list[Column]:
    """Two 64-bit hashes with independent seeds."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(0x9E3779B97F4A7C15 >> 1), *columns)]


#: A node is a hub if it has more neighbours than this and than this share of all links (so there are few hubs).
HUB, HUB_SHARE = 1000, 1 / 1000
#: So many nodes are broadcast, hubs or not: then no round shuffles a link by its ends.
FEW = 100_000


def with_least(rows: DataFrame, least: DataFrame, limit: int) -> DataFrame:
    """rows (a, b) with m of least (a, m, n), where a has n neighbours in all.

    Hubs (n over the limit, at most twice the links divided by it) are broadcast, so that their rows stay where they
    are; the others are joined. All are hubs if the limit is 0.
    """
    hubs = F.broadcast(least.where(F.col("n") > limit).select("a", "m"))
    if not limit:
        return rows.join(hubs, "a")
    others = least.where(F.col("n") <= limit).select("a", "m")
    return rows.join(hubs, "a").unionByName(rows.join(hubs.select("a"), "a", "left_anti").join(others, "a"))


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of the links (a, b), any two orderable ids: (node, component), the component's least node.

    Alternates large-star and small-star steps (Kiveris et al., 2014); each shrinks the depth of the trees
    geometrically, and no step gathers a node's neighbours in one row or a hub's in one task. What a step needs twice is
    written to the checkpoint folder, so that a round has three shuffles where nodes are few (those of the least
    neighbours, twice, and of the new links), and it is the last if every larger node has one link. Nodes without links
    aren't returned. Self-links and repeated links are harmless.
    """
    edges = checkpointed(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(rounds):
        both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        least = checkpointed(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n")))
        nodes, ends, deep = least.agg(F.count("*"), F.sum("n"), F.count_if((F.col("m") != F.col("a")) & (F.col("n") > 1))).first()
        if not deep:
            return least.select(F.col("a").alias("node"), F.col("m").alias("component"))
        limit = 0 if nodes <= FEW else max(HUB, int(ends // 2 * HUB_SHARE))
        kept = checkpointed if limit else lambda df: df  # what takes no shuffle is as well made twice
        # large-star: larger neighbours of each node go to the least node of its neighbourhood
        large = kept(with_least(edges.select(F.col("b").alias("a"), F.col("a").alias("b")), least, limit).select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small-star: a node and its smaller neighbours go to the least of them
        low = checkpointed(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
        small = with_least(large, low, limit).where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
    raise RuntimeError("the components did not settle")
