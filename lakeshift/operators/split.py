"""Split plans of large tables: ranges of an integer key, or ranges of pages, and scans by part.

Bounds are null where open. The first part of a key split is the one of null keys; the last part of any split has no
upper bound. A plan of one part is a scan of the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PLAN = "table_name string, partnum int, partcount int, lo long, hi long, is_null_part boolean"


@dataclass(frozen=True)
class Part:
    partnum: int
    partcount: int
    lo: int | None = None
    hi: int | None = None
    is_null_part: bool = False

    @property
    def count(self) -> int | None:
        return None if self.lo is None or self.hi is None else self.hi - self.lo + 1


def _ceil(a: int, b: int) -> int:
    return -(-a // b)


def key_parts(total_bytes: int, part_bytes: int, least: int, most: int, max_parts: int = 0) -> list[Part]:
    """One part for nulls, then equal ranges of [least, most]; the width is that of a division by all parts, as is usual here."""
    n = _ceil(total_bytes, part_bytes) + 1
    n = min(n, max_parts) if max_parts > 0 else n
    if n <= 1:
        return [Part(1, 1)]
    width = _ceil(most - least + 1, n)
    ranges = [Part(k + 1, n, least + (k - 1) * width, None if k == n - 1 else least + k * width - 1) for k in range(1, n)]
    return [Part(1, n, is_null_part=True), *ranges]


def page_parts(pages: int, part_bytes: int, page_bytes: int = 8192, max_parts: int = 0) -> list[Part]:
    """Ranges of pages from 0."""
    n = _ceil(pages, max(1, _ceil(part_bytes, page_bytes)))
    n = min(n, max_parts) if max_parts > 0 else n
    if n <= 1:
        return [Part(1, 1)]
    width = _ceil(pages, n)
    return [Part(k + 1, n, k * width, None if k == n - 1 else (k + 1) * width - 1) for k in range(n)]


def split_method(total_bytes: int, threshold: int, key: str | None, physical: bool = True, standby: bool = False) -> str:
    """How a table is split: none (small, or nothing to split by), key, or pages."""
    if total_bytes < threshold:
        return "none"
    if key is not None:
        return "key"
    return "pages" if physical and not standby else "none"


def key_bounds(df: DataFrame, key: str) -> tuple[int | None, int | None]:
    """The least and largest key, from Parquet statistics where they can be used."""
    return tuple(df.agg(F.min(key).cast("long"), F.max(key).cast("long")).first())


def plan_key_split(df: DataFrame, name: str, key: str, total_bytes: int, part_bytes: int, max_parts: int = 0) -> DataFrame:
    least, most = key_bounds(df, key)
    parts = [Part(1, 1)] if least is None else key_parts(total_bytes, part_bytes, least, most, max_parts)
    return as_frame(df.sparkSession, name, parts)


def as_frame(spark: SparkSession, name: str, parts: list[Part]) -> DataFrame:
    return spark.createDataFrame([(name, p.partnum, p.partcount, p.lo, p.hi, p.is_null_part) for p in parts], PLAN)


def predicate(part: Part, key: str) -> Column:
    """The rows of one part."""
    if part.partcount == 1:
        return F.lit(True)
    if part.is_null_part:
        return F.col(key).isNull()
    if part.hi is None:
        return F.col(key) >= part.lo
    return F.col(key).between(part.lo, part.hi)


def predicate_sql(part: Part, key: str) -> str:
    if part.partcount == 1:
        return ""
    if part.is_null_part:
        return f"WHERE {key} IS NULL"
    return f"WHERE {key} >= {part.lo}" if part.hi is None else f"WHERE {key} BETWEEN {part.lo} AND {part.hi}"


def scan(df: DataFrame, part: Part, key: str, columns: list[str] | None = None) -> DataFrame:
    """The rows of a part; the range reaches the Parquet reader as a pushed filter."""
    return df.where(predicate(part, key)).select(*(columns or df.columns))


def scan_all(df: DataFrame, parts: list[Part], key: str, columns: list[str] | None = None) -> DataFrame:
    """All parts, with their number: one pass over the table, however many they are."""
    return df.select(*(columns or df.columns), part_of(F.col(key), parts).alias("partnum"))


def part_of(key: Column, parts: list[Part]) -> Column:
    """The number of the part that holds a key: one pass over the table gives all parts."""
    if len(parts) == 1:
        return F.lit(1)
    ranges = [p for p in parts if not p.is_null_part]
    width = (ranges[0].hi - ranges[0].lo + 1) if ranges[0].hi is not None else 1
    number = F.least(F.floor((key - ranges[0].lo) / width) + ranges[0].partnum, F.lit(parts[-1].partnum))
    return F.when(key.isNull(), 1).otherwise(number).cast("int")


def deal(df: DataFrame, parts: list[Part], key: str) -> DataFrame:
    """The table repartitioned by part, for one write of all parts."""
    return df.withColumn("partnum", part_of(F.col(key), parts)).repartition(len(parts), "partnum")
