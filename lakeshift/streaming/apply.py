"""Applying changes: the state of each key is the fold of its changes in commit order, as one aggregation.

A column's value is the last one sent for it: unchanged ones aren't sent and so keep what was before. A deletion or a
truncation forgets everything before it. Nothing is sorted and no key's changes are gathered, so that hot keys are
combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(changes: DataFrame, key: list[str], columns: list[str], order: list[str], unchanged: dict[str, Column] | None = None, truncated: DataFrame | None = None) -> DataFrame:
    """(key, columns): rows that are there after all changes (key, action, columns, order).

    unchanged: for a column, where it wasn't sent. truncated: one row (at) with the order of the last truncation.
    """
    at = F.struct(*order)
    put = F.col("action").isin("I", "U")
    sent = lambda c: put & ~F.coalesce((unchanged or {}).get(c, F.lit(False)), F.lit(False))
    last = [F.max_by(F.struct(F.col(c).alias("v"), at.alias("at")), F.when(sent(c), at)).alias(f"_{c}") for c in columns]
    x = changes.where(F.col("action").isin("I", "U", "D")).groupBy(*key).agg(F.max(F.when(put, at)).alias("_put"), F.max(F.when(F.col("action") == "D", at)).alias("_gone"), *last)
    if truncated is not None:
        x = x.crossJoin(truncated.select(F.col("at").alias("_cut")))  # one row
        x = x.withColumn("_gone", F.greatest("_gone", "_cut"))
    alive = F.col("_put").isNotNull() & (F.col("_gone").isNull() | (F.col("_put") > F.col("_gone")))
    kept = lambda c: F.when(F.col("_gone").isNull() | (F.col(f"_{c}.at") > F.col("_gone")), F.col(f"_{c}.v")).alias(c)
    return x.where(alive).select(*key, *[kept(c) for c in columns])


def last_truncation(changes: DataFrame, order: list[str]) -> DataFrame:
    """One row with the order of the last truncation, null if there is none."""
    return changes.agg(F.max(F.when(F.col("action") == "T", F.struct(*order))).alias("at"))


def with_moved_keys(changes: DataFrame, key: list[str], old: list[str]) -> DataFrame:
    """Updates that change the key become a deletion of the old one and an insertion of the new one."""
    moved = (F.col("action") == "U") & F.col(old[0]).isNotNull() & ~F.struct(*old).eqNullSafe(F.struct(*key))
    kinds = F.when(moved, F.array(F.lit("D"), F.lit("I"))).otherwise(F.array("action"))
    x = changes.select("*", F.posexplode(kinds).alias("_k", "_a"))
    gone = moved & (F.col("_a") == "D")
    take = {k: F.when(gone, F.col(o)).otherwise(F.col(k)) for k, o in zip(key, old, strict=True)}
    return x.select(*[take[c].alias(c) if c in take else F.col("_a").alias(c) if c == "action" else F.col(c) for c in changes.columns], F.col("_k").alias("step"))


def merged(state: DataFrame, changes: DataFrame, key: list[str], columns: list[str], order: list[str], unchanged: dict[str, Column] | None = None) -> DataFrame:
    """A state after changes: its rows take part as insertions before everything."""
    first = state.select(*key, *columns, F.lit("I").alias("action"), *[F.lit(None).cast(dict(changes.dtypes)[c]).alias(c) for c in order])
    low = {c: F.coalesce(F.col(c), F.lit(-1).cast(dict(changes.dtypes)[c])) for c in order}
    flags = {f"_u_{c}": u for c, u in (unchanged or {}).items()}
    rows = changes.select(*key, *columns, "action", *order, *[F.coalesce(u, F.lit(False)).alias(n) for n, u in flags.items()])
    first = first.select("*", *[F.lit(False).alias(n) for n in flags])
    both = first.unionByName(rows).withColumns(low)
    cut = last_truncation(changes, order)
    return fold(both, key, columns, order, {c: F.col(f"_u_{c}") for c in (unchanged or {})}, cut)


def refreshes(changes: DataFrame, views: DataFrame) -> DataFrame:
    """(xid, nspname, relname): one refresh for each transaction and materialised view that its changes touch."""
    return changes.join(views.select("nspname", "relname"), ["nspname", "relname"], "left_semi").select("xid", "nspname", "relname").distinct()
