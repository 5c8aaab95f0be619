"""Comparison of a source and a target: data by checksums, schemas by their objects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.functions.checksum import table_checksum


def checksums(tables: dict[str, DataFrame], columns: dict[str, list[str]] | None = None, portable: bool = False) -> DataFrame:
    """(table_name, row_count, checksum), a row for each table; all of them run as one job."""
    of = lambda name, df: table_checksum(df, (columns or {}).get(name), portable).select(F.lit(name).alias("table_name"), "row_count", "checksum")
    return reduce(DataFrame.unionByName, [of(n, df) for n, df in tables.items()])


def compare_data(source: dict[str, DataFrame], target: dict[str, DataFrame], portable: bool = False) -> DataFrame:
    """(table_name, source_rows, target_rows, source_checksum, target_checksum, status).

    Both sides are read by the source's column list. status: ok, rows (the counts differ, so checksums say no more),
    checksum, or missing (there is no such target). portable: by the form that other engines can compute.
    """
    lists = {n: df.columns for n, df in source.items()}
    there = {n: df for n, df in target.items() if n in source}
    a = checksums(source, lists, portable).toDF("table_name", "source_rows", "source_checksum")
    if not there:
        return a.select("table_name", "source_rows", F.lit(None).cast("long").alias("target_rows"), "source_checksum", F.lit(None).cast("string").alias("target_checksum"), F.lit("missing").alias("status"))
    b = checksums(there, lists, portable).toDF("table_name", "target_rows", "target_checksum")
    status = F.when(F.col("target_rows").isNull(), "missing").when(F.col("source_rows") != F.col("target_rows"), "rows").when(F.col("source_checksum") != F.col("target_checksum"), "checksum").otherwise("ok")
    return a.join(b, "table_name", "left").select("table_name", "source_rows", "target_rows", "source_checksum", "target_checksum", status.alias("status"))


def compare_many(sides: dict[str, tuple[dict[str, DataFrame], dict[str, DataFrame]]], portable: bool = False) -> DataFrame:
    """compare_data over several databases: their name comes first."""
    return reduce(DataFrame.unionByName, [compare_data(a, b, portable).select(F.lit(d).alias("datname"), "*") for d, (a, b) in sides.items()])


def compare_objects(source: DataFrame, target: DataFrame, keys: list[str], attributes: list[str], kind: str, both: bool = False) -> DataFrame:
    """Differences of objects by name: (kind, object, difference).

    Only the source's objects count, unless ``both``. difference: missing, extra, or the attributes that differ, nulls
    being equal. Objects match by their keys, not by position.
    """
    a = source.select(*keys, *[F.col(c).alias(f"a_{c}") for c in attributes], F.lit(1).alias("in_a"))
    b = target.select(*keys, *[F.col(c).alias(f"b_{c}") for c in attributes], F.lit(1).alias("in_b"))
    x = a.join(b, keys, "full" if both else "left")
    differs = F.concat_ws(",", *[F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in attributes])
    x = x.withColumn("difference", F.when(F.col("in_b").isNull(), "missing").when(F.col("in_a").isNull(), "extra").otherwise(differs))
    return x.where("difference <> ''").select(F.lit(kind).alias("kind"), F.concat_ws(".", *keys).alias("object"), "difference")


def compare_counts(source: DataFrame, target: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """Objects whose numbers of parts differ (columns or indexes of a table): (kind, object, difference)."""
    a, b = (x.groupBy(*keys).agg(F.count("*").alias(n)) for x, n in ((source, "a"), (target, "b")))
    x = a.join(b, keys, "left").where(F.col("a") != F.coalesce("b", F.lit(0)))
    return x.select(F.lit(kind).alias("kind"), F.concat_ws(".", *keys).alias("object"), F.concat(F.col("a").cast("string"), F.lit(" <> "), F.coalesce("b", F.lit(0)).cast("string")).alias("difference"))


def compare_schemas(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Differences of two catalogs with the relations s_table, s_attr, s_index, s_constraint and s_seq."""
    named = ["nspname", "relname"]
    parts = [compare_objects(source["s_table"], target["s_table"], named, [], "table")]
    if "s_attr" in source:
        parts += [compare_objects(source["s_attr"], target["s_attr"], [*named, "attname"], ["typname"], "column"), compare_counts(source["s_attr"], target["s_attr"], named, "columns")]
    if "s_index" in source:
        parts.append(compare_objects(source["s_index"], target["s_index"], named, ["tablename", "isprimary", "isunique", "columns", "sql"], "index"))
    if "s_constraint" in source:
        parts.append(compare_objects(source["s_constraint"], target["s_constraint"], [*named, "conname"], ["condeferrable", "condeferred", "sql"], "constraint"))
    if "s_seq" in source:
        parts.append(compare_objects(source["s_seq"], target["s_seq"], named, ["last_value", "is_called"], "sequence"))
    return reduce(DataFrame.unionByName, parts)


def counts_by_side(objects: DataFrame) -> DataFrame:
    """(datname, kind, source, target): how many objects (datname, side, kind) each database has on either side."""
    return objects.groupBy("datname", "kind").pivot("side", ["source", "target"]).agg(F.count(F.lit(1))).na.fill(0, ["source", "target"])
