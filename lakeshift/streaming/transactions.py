"""Transactions of a change log (id, action, xid, lsn, ...): deliveries, completeness, order, and what to apply.

Actions: B begins, C commits, R rolls back; I, U, D and T change rows; K keeps alive; X switches segments; E ends.
A transaction is seen once its end is; log positions of 0 are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DML = ("I", "U", "D", "T")
NO_LSN = 0


def last_delivery(log: DataFrame) -> DataFrame:
    """Of messages that were delivered again, the last (highest id) for each action and position; there, ids are unique."""
    rest = [c for c in log.columns if c not in ("action", "lsn")]
    return log.groupBy("action", "lsn").agg(F.max_by(F.struct(*rest), "id").alias("r")).select(*[F.col("r").getField(c).alias(c) if c in rest else F.col(c) for c in log.columns])


def transactions(log: DataFrame) -> DataFrame:
    """(xid, begin_id, begin_lsn, end_id, end_lsn, outcome, n_dml): a row for each transaction begun.

    The last BEGIN of an xid counts, as it may be delivered again; its end is the first COMMIT after that or else the
    first ROLLBACK. outcome: commit, rollback or open.
    """
    begun = log.where("action = 'B'").groupBy("xid").agg(F.max("id").alias("begin_id"), F.max_by("lsn", "id").alias("begin_lsn"))
    rest = log.where(F.col("action").isin("C", "R", *DML)).select("xid", "id", "lsn", "action")
    x = begun.join(rest, "xid", "left").where(F.col("id").isNull() | (F.col("id") > F.col("begin_id")))
    end = lambda a: F.min(F.when(F.col("action") == a, F.struct("id", "lsn")))
    x = x.groupBy("xid", "begin_id", "begin_lsn").agg(end("C").alias("c"), end("R").alias("r"), F.count(F.when(F.col("action").isin(*DML), 1)).alias("n_dml"))
    # transactions all of whose rows are older than their last BEGIN are open
    x = begun.join(x.drop("begin_lsn"), ["xid", "begin_id"], "left")
    outcome = F.when(F.col("c").isNotNull(), "commit").when(F.col("r").isNotNull(), "rollback").otherwise("open")
    return x.select("xid", "begin_id", "begin_lsn", F.coalesce("c.id", "r.id").alias("end_id"), F.coalesce("c.lsn", "r.lsn").alias("end_lsn"), outcome.alias("outcome"), F.coalesce("n_dml", F.lit(0)).cast("long").alias("n_dml"))


def complete(log: DataFrame) -> DataFrame:
    """The rows of transactions that have ended, from their last BEGIN on."""
    t = transactions(log).where("outcome <> 'open'").select("xid", "begin_id", "end_id")
    return log.join(t, "xid").where("id BETWEEN begin_id AND end_id").select(*log.columns)


def without_empty(log: DataFrame) -> DataFrame:
    """The log without the BEGIN and COMMIT of transactions that change nothing."""
    empty = transactions(log).where("n_dml = 0 AND outcome <> 'open'").select("xid")
    ends = F.col("action").isin("B", "C", "R")
    return log.where(~ends).unionByName(log.where(ends).join(empty, "xid", "left_anti").select(*log.columns))


def next_unit(log: DataFrame, cursor: int) -> DataFrame:
    """The unit at or after a cursor: a BEGIN at the position or later, or a KEEPALIVE, SWITCH later; one row at most.

    A COMMIT has the position of the next BEGIN, which so is not passed over, while a KEEPALIVE is taken once.
    """
    units = log.where(((F.col("action") == "B") & (F.col("lsn") >= cursor)) | (F.col("action").isin("K", "X") & (F.col("lsn") > cursor)))
    order = F.struct("lsn", F.when(F.col("action") == "B", 0).otherwise(1), "id")
    return units.agg(F.min_by(F.struct(*log.columns), order).alias("u")).where("u IS NOT NULL").select("u.*")


def decision(begin: Column, end: Column, cursor: Column, endpos: Column) -> Column:
    """What to do with a transaction: wait (it hasn't ended), skip (applied before), stop (it begins beyond the end
    position), apply and then stop (the end position is within), or apply. An end position of 0 is none."""
    has_end = endpos != NO_LSN
    return (
        F.when(end.isNull(), "wait").when(end <= cursor, "skip").when(has_end & (endpos < begin), "stop")
        .when(has_end & (begin < endpos) & (endpos < end), "apply and stop").otherwise("apply")
    )


def in_commit_order(log: DataFrame) -> DataFrame:
    """Changes of committed transactions with their place: (commit_lsn, id) is the order in which they are applied."""
    t = transactions(log).where("outcome = 'commit'").select("xid", "begin_id", "end_id", F.col("end_lsn").alias("commit_lsn"))
    return log.where(F.col("action").isin(*DML)).join(t, "xid").where("id BETWEEN begin_id AND end_id").drop("begin_id", "end_id")


def without_transactions(log: DataFrame, xids: DataFrame) -> DataFrame:
    """The log without some transactions, as when a part of one is dropped."""
    return log.join(xids.select("xid").distinct(), "xid", "left_anti")


def with_run(changes: DataFrame, same: list[str], order: list[str], most: int | None = None, params: Column | None = None) -> DataFrame:
    """Adjacent rows of a transaction that are alike get one number (column run).

    same: columns in which neighbours must agree. most and params: a run is cut before its parameters would exceed a
    bound; the cut is by the running sum, so that a run is no longer than the bound (a single row may be).
    """
    w = Window.partitionBy("xid").orderBy(*order)
    breaks = [~F.lag(c).over(w).eqNullSafe(F.col(c)) for c in same]
    new = breaks[0]
    for b in breaks[1:]:
        new = new | b
    x = changes.withColumn("_new", (F.row_number().over(w) == 1) | new).withColumn("run", F.sum(F.col("_new").cast("int")).over(w)).drop("_new")
    if most is not None:
        r = Window.partitionBy("xid", "run").orderBy(*order)
        # rows of a run are alike and so have equally many parameters
        x = x.withColumn("_n", params).withColumn("_part", F.floor((F.row_number().over(r) - 1) / F.greatest(F.lit(1), F.floor(F.lit(most) / F.greatest(F.first("_n").over(r), F.lit(1))))))
        x = x.withColumn("run", F.concat_ws(".", "run", F.col("_part").cast("long"))).drop("_n", "_part")
    return x
