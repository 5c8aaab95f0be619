"""Control state of a pipeline: positions, runs, and the segments of a log; a few rows each, as events or frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

POSITIONS = ("startpos", "endpos", "write_lsn", "flush_lsn", "replay_lsn")


def sentinel(events: DataFrame) -> DataFrame:
    """One row: positions only move forward, start and end positions and the apply flag are the last ones set (by seq)."""
    forward = [F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in ("write_lsn", "flush_lsn", "replay_lsn")]
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c)
    return events.agg(last("startpos"), last("endpos"), last("apply"), *forward)


def reached(replay: Column, endpos: Column) -> Column:
    return (endpos != 0) & (replay >= endpos)


def progressed(before: Column, after: Column) -> Column:
    """Whether two states differ."""
    return ~before.eqNullSafe(after)


def runs(events: DataFrame) -> DataFrame:
    """The state of each process (process, seq, event, lsn): running, done or error, the open transaction, the last position.

    Events: start, txn_begin (xid), txn_done (xid), sync, end (ok).
    """
    last = lambda c, on: F.max_by(c, F.when(on, F.col("seq")))
    e = F.col("event")
    x = events.groupBy("process").agg(
        F.max(F.when(e == "start", F.col("seq"))).alias("started"), F.max(F.when(e == "end", F.col("seq"))).alias("ended"), last("ok", e == "end").alias("ok"),
        F.max(F.when(e == "txn_begin", F.col("seq"))).alias("b"), F.max(F.when(e == "txn_done", F.col("seq"))).alias("d"), last("xid", e == "txn_begin").alias("xid"), last("lsn", F.col("lsn").isNotNull()).alias("lsn"),
    )
    status = F.when(F.col("ended") > F.col("started"), F.when(F.col("ok"), "done").otherwise("error")).otherwise("running")
    return x.select("process", status.alias("status"), F.when(F.col("b") > F.coalesce("d", F.lit(-1)), F.col("xid")).alias("pending_xid"), "lsn")


#: Into how many ranges positions are cut where running sums and range joins need it.
RANGES = 4096


def range_step(df: DataFrame, column: str) -> tuple[int, int]:
    """The least position, and a width of which RANGES cover all."""
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    return (lo, (hi - lo) // RANGES + 1) if lo is not None else (0, 1)


def segments(log: DataFrame, most_bytes: int, size: Column) -> DataFrame:
    """The log with segment_id: a new one begins with the transaction after which the one before holds most_bytes.

    Sizes are added up by transaction, then by ranges of positions, so that the running sum over all is one over at most
    RANGES rows, and each range sums its own transactions.
    """
    t = log.groupBy("xid").agg(F.min("lsn").alias("first_lsn"), F.sum(size).alias("bytes"))
    lo, step = range_step(log, "lsn")
    t = t.withColumn("range", F.floor((F.col("first_lsn") - lo) / step))
    before = t.groupBy("range").agg(F.sum("bytes").alias("range_bytes"))
    before = before.select("range", (F.sum("range_bytes").over(Window.orderBy("range")) - F.col("range_bytes")).alias("before"))
    w = Window.partitionBy("range").orderBy("first_lsn", "xid").rowsBetween(Window.unboundedPreceding, -1)
    t = t.join(before, "range").withColumn("segment_id", F.floor((F.col("before") + F.coalesce(F.sum("bytes").over(w), F.lit(0))) / most_bytes).cast("long"))
    return log.join(t.select("xid", "segment_id"), "xid")


def segment_bounds(log: DataFrame) -> DataFrame:
    """(segment_id, startpos, endpos): the last one is open."""
    x = log.groupBy("segment_id").agg(F.min("lsn").alias("startpos"), F.max("lsn").alias("last"))
    w = Window.orderBy("segment_id")  # a row for each segment file
    return x.select("segment_id", "startpos", F.when(F.lead("segment_id").over(w).isNotNull(), F.col("last")).alias("endpos"))


def segment_of(positions: DataFrame, bounds: DataFrame) -> DataFrame:
    """(lsn, segment_id): for each position the first segment that holds it, null if none does.

    A range join as an equi-join: positions are cut into ranges, and a segment goes to each range that it touches.
    """
    lo, step = range_step(positions, "lsn")
    last = lo + step * RANGES
    of = lambda c: F.floor((c - lo) / step)
    b = bounds.select("segment_id", "startpos", F.least(F.coalesce("endpos", F.lit(last)), F.lit(last)).alias("stop"), F.greatest("startpos", F.lit(lo)).alias("begin")).where("begin <= stop")
    b = b.select("segment_id", "startpos", "stop", F.explode(F.sequence(of(F.col("begin")), of(F.col("stop")))).alias("range"))
    p = positions.select("lsn").distinct().withColumn("range", of(F.col("lsn")))
    found = p.join(b, "range", "left").withColumn("in", (F.col("lsn") >= F.col("startpos")) & (F.col("lsn") <= F.col("stop")))
    return found.groupBy("lsn").agg(F.min(F.when(F.col("in"), F.col("segment_id"))).alias("segment_id"))


def successors(bounds: DataFrame) -> DataFrame:
    """(segment_id, next_id): the next segment once one is closed."""
    w = Window.orderBy("segment_id")  # a row for each segment file
    return bounds.select("segment_id", F.when(F.col("endpos").isNotNull(), F.lead("segment_id").over(w)).alias("next_id"))


def prunable(bounds: DataFrame, replay_lsn: int) -> DataFrame:
    """Closed segments that were applied as a whole."""
    return bounds.where(F.col("endpos").isNotNull() & (F.col("endpos") < replay_lsn))


def timelines(history: DataFrame) -> DataFrame:
    """Ranges of the timelines of a history (tli, switch_lsn): each begins where the one before was left."""
    w = Window.orderBy("tli")  # a handful of rows
    return history.select("tli", F.coalesce(F.lag("switch_lsn").over(w), F.lit(0)).alias("begin_lsn"), F.col("switch_lsn").alias("end_lsn"))
