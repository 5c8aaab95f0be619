"""Progress and summaries as append-only events: counts, totals, elections, timings, reports.

What a catalog would update in place is here the aggregate of what was appended, so that writers never meet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeshift.functions.text import pretty_bytes, pretty_interval

#: Jobs as bits of a mask: which worker counts a section's concurrency adds up.
JOBS = {"copy": 1, "index": 2, "vacuum": 4, "large_objects": 8}


def accumulated(events: DataFrame) -> DataFrame:
    """Totals of each section (section, count, bytes, duration_ms): the sum of all increments, nulls as zero."""
    total = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long").alias(c)
    return events.groupBy("section").agg(total("count"), total("bytes"), total("duration_ms"))


def all_databases(events: DataFrame) -> DataFrame:
    """Timings over all databases (datname, section, ...), by section."""
    return accumulated(events.drop("datname"))


def latest(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The last row written for each key: replace by key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def elected(done: DataFrame, keys: list[str], who: str, order: list[str]) -> DataFrame:
    """The first finisher of each key: later ones are ignored."""
    return done.groupBy(*keys).agg(F.min_by(who, F.struct(*order)).alias(who))


def parts_done(parts: DataFrame) -> DataFrame:
    """(tableoid, partcount, done, all_done) of parts (tableoid, partcount, done_time)."""
    return parts.groupBy("tableoid", "partcount").agg(F.count("done_time").alias("done")).withColumn("all_done", F.col("done") == F.col("partcount"))


def done_counts(tables: DataFrame, parts: DataFrame, indexes: DataFrame | None = None) -> DataFrame:
    """One row: tables, tables_done (all of their parts are), indexes, indexes_done."""
    t = tables.agg(F.count("*").alias("tables"))
    d = parts_done(parts).agg(F.coalesce(F.sum(F.col("all_done").cast("long")), F.lit(0)).alias("tables_done"))
    out = t.crossJoin(d)  # single rows
    if indexes is not None:
        out = out.crossJoin(indexes.agg(F.count("*").alias("indexes"), F.count("done_time").alias("indexes_done")))
    return out


def byte_totals(parts: DataFrame) -> DataFrame:
    """One row: bytes of all parts, of those done, and of those begun but not done."""
    of = lambda c: F.coalesce(F.sum(F.when(c, F.col("bytes"))), F.lit(0)).cast("long")
    done, begun = F.col("done_time").isNotNull(), F.col("start_time").isNotNull()
    return parts.agg(of(F.lit(True)).alias("total"), of(done).alias("done"), of(begun & ~done).alias("in_progress"))


def in_progress(process: DataFrame, tables: DataFrame, summary: DataFrame, parts: DataFrame) -> DataFrame:
    """Tables that processes copy now: process, table and its begun summary, with the part if there is one."""
    s = summary.where("start_time IS NOT NULL AND done_time IS NULL").select("tableoid", "partnum", "pid", "start_time")
    x = process.join(s, ["pid", "tableoid", "partnum"]).join(tables, F.col("tableoid") == F.col("oid"))
    p = parts.select(F.col("tableoid").alias("p_oid"), F.col("partnum").alias("p_num"), "partcount", "lo", "hi")
    return x.join(p, (F.col("tableoid") == F.col("p_oid")) & (F.col("partnum") == F.col("p_num")), "left").drop("p_oid", "p_num")


def table_report(tables: DataFrame, parts: DataFrame, summary: DataFrame, checksums: DataFrame) -> DataFrame:
    """A row for each table; parts and summaries are added up first, so that neither multiplies the other."""
    p = parts.groupBy(F.col("tableoid").alias("oid")).agg(F.count("*").alias("partcount"))
    s = summary.groupBy(F.col("tableoid").alias("oid")).agg(F.sum("duration_ms").alias("duration_ms"), F.sum("bytes").alias("bytes_sent"))
    return tables.join(p, "oid", "left").join(s, "oid", "left").join(checksums, "oid", "left").orderBy(F.desc("bytes"), "oid")


def not_built(indexes: DataFrame, done: DataFrame) -> DataFrame:
    """(tableoid, n): how many indexes of a table aren't done."""
    return indexes.join(done.select("indexoid"), "indexoid", "left_anti").groupBy("tableoid").agg(F.count("*").alias("n"))


def ready_for_constraints(indexes: DataFrame, done: DataFrame) -> DataFrame:
    """Tables all of whose indexes are built."""
    return indexes.select("tableoid").distinct().join(not_built(indexes, done), "tableoid", "left_anti")


def without_incomplete(summary: DataFrame) -> DataFrame:
    """What a run that goes on may trust: rows that were done."""
    return summary.where("done_time IS NOT NULL")


def schedule(tables: DataFrame, workers: int) -> DataFrame:
    """Copies in order, the largest first over all databases, with the worker whose turn it is."""
    w = Window.orderBy(F.desc("bytes"), "datname", "oid")  # a catalog's rows: parts to copy, not data
    return tables.withColumn("position", F.row_number().over(w)).withColumn("worker", (F.col("position") - 1) % workers)


def concurrency(mask: Column, workers: dict[str, int]) -> Column:
    """How many processes a section runs, from the bits of its jobs."""
    return reduce(lambda a, b: a + b, [F.when(mask.bitwiseAND(F.lit(bit)) != 0, F.lit(workers.get(job, 0))).otherwise(0) for job, bit in JOBS.items()])


def summary_table(timings: DataFrame) -> DataFrame:
    """Timings with readable durations and sizes."""
    return timings.withColumn("duration_pretty", pretty_interval(F.col("duration_ms"))).withColumn("bytes_pretty", pretty_bytes(F.col("bytes")))


def as_json(tables: DataFrame, timings: DataFrame) -> DataFrame:
    """One JSON document: {"tables": [...], "steps": [...]}; catalogs and summaries only."""
    t = tables.agg(F.array_sort(F.collect_list(F.struct(*tables.columns))).alias("tables"))
    s = timings.agg(F.array_sort(F.collect_list(F.struct(*timings.columns))).alias("steps"))
    return t.crossJoin(s).select(F.to_json(F.struct("tables", "steps")).alias("json"))
