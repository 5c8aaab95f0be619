"""Sources and sinks besides plain tables: row text of bulk copies, change logs in files, large objects, archive lists."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What the text format of bulk copies escapes, and how.
ESCAPES = {"\\": "\\\\", "\t": "\\t", "\n": "\\n", "\r": "\\r", "\b": "\\b", "\f": "\\f", "\x0b": "\\v"}
MESSAGE = "action string, xid string, lsn string, timestamp string, message string"


def tables(spark: SparkSession, path: str, names: list[str], kind: str = "parquet") -> dict[str, DataFrame]:
    """Tables of a folder by name, in any format that Spark reads."""
    suffix = {"parquet": ".parquet", "orc": ".orc", "json": ".json", "csv": ".csv"}[kind]
    reader = spark.read.option("header", True) if kind == "csv" else spark.read
    return {n: reader.format(kind).load(f"{path}/{n}{suffix}") for n in names}


def jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 1, **options) -> DataFrame:
    """A table of a database, read by ranges of a key as a split plan has them."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if key is not None and bounds is not None:
        reader = reader.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
    return reader.options(**options).load()


def copy_text(df: DataFrame) -> DataFrame:
    """Rows (line) in the text format of bulk copies: tabs between columns, \\N for nulls, escapes."""

    def field(c: Column, kind: T.DataType) -> Column:
        text = F.when(c, "t").otherwise("f") if isinstance(kind, T.BooleanType) else c.cast("string")
        for raw, escaped in ESCAPES.items():
            text = F.replace(text, F.lit(raw), F.lit(escaped))
        return F.when(c.isNull(), F.lit("\\N")).otherwise(text)

    return df.select(F.concat_ws("\t", *[field(F.col(f.name), f.dataType) for f in df.schema.fields]).alias("line"))


def unescaped(text: Column) -> Column:
    """A field's value; a letter after a backslash stands for itself if it has no meaning."""
    parts = F.split(text, "\\\\\\\\", -1)  # between escaped backslashes, other escapes are simple
    x = parts
    for raw, escaped in list(ESCAPES.items())[1:]:
        x = F.transform(x, _replacing(escaped, raw))
    return F.when(text != "\\N", F.array_join(x, "\\"))


def _replacing(old: str, new: str):
    return lambda p: F.replace(p, F.lit(old), F.lit(new))


def from_copy_text(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of text lines; malformed numbers are nulls."""
    fields = F.split("line", "\t", -1)
    out = []
    for k, f in enumerate(schema.fields):
        v = unescaped(F.get(fields, F.lit(k)))
        out.append((v == "t" if isinstance(f.dataType, T.BooleanType) else v.try_cast(f.dataType)).alias(f.name))
    return lines.select(*out)


def change_log(spark: SparkSession, path: str) -> DataFrame:
    """Messages of JSON-lines files: (action, xid, lsn, timestamp, message), the position as a number."""
    from lakeshift.functions.text import lsn_parse

    x = spark.read.schema(MESSAGE).json(path)
    return x.withColumn("xid", F.col("xid").try_cast("long")).withColumn("lsn", lsn_parse(F.col("lsn")))


def change_log_stream(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    from lakeshift.functions.text import lsn_parse

    x = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files).json(path)
    return x.withColumn("xid", F.col("xid").try_cast("long")).withColumn("lsn", lsn_parse(F.col("lsn")))


def large_objects(spark: SparkSession, path: str) -> DataFrame:
    """(oid, bytes, content) of a folder with a file for each large object; files of no bytes aren't listed by the reader."""
    x = spark.read.format("binaryFile").load(path)
    return x.select(F.regexp_extract("path", r"(\d+)[^/]*$", 1).try_cast("long").alias("oid"), F.col("length").alias("bytes"), "content")


def object_pieces(objects: DataFrame, size: int = 16 << 20) -> DataFrame:
    """(oid, piece, content): contents in pieces, so that none is larger than a buffer."""
    n = F.greatest(F.ceil(F.col("bytes") / size).cast("int"), F.lit(1))
    x = objects.select("oid", "content", F.explode(F.sequence(F.lit(0), n - 1)).alias("piece"))
    return x.select("oid", "piece", F.substring("content", F.col("piece") * size + 1, F.lit(size)).alias("content"))


def write_objects(objects: DataFrame, folder: str) -> DataFrame:
    """Writes each object as a file on a path that tasks can open; (oid, bytes) as written."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for oid, content in zip(b["oid"], b["content"], strict=True):
                with open(f"{folder}/{oid}", "wb") as f:
                    f.write(content)
            yield pd.DataFrame({"oid": b["oid"], "bytes": [len(c) for c in b["content"]]})

    return objects.select("oid", "content").mapInPandas(write, "oid long, bytes long")


def archive_entries(lines: DataFrame) -> DataFrame:
    """Entries of an archive list (value): (dump_id, catoid, oid, description, restore_list_name, skipped).

    "12; 1259 16385 TABLE public film owner"; comments and blank lines are left out, but not entries that are commented
    out to be skipped.
    """
    line = r"^(;?)\s*(\d+); (\d+) (\d+) ([A-Z][A-Z ]*[A-Z]) (.*)$"
    of = lambda k: F.regexp_extract("value", line, k)
    x = lines.where(F.col("value").rlike(line))
    return x.select(of(2).cast("int").alias("dump_id"), of(3).cast("long").alias("catoid"), of(4).cast("long").alias("oid"), of(5).alias("description"), of(6).alias("restore_list_name"), (of(1) == ";").alias("skipped"))


def restore_list(entries: DataFrame) -> DataFrame:
    """The list's lines (dump_id, line), those with the flag filtered commented out."""
    text = F.concat_ws(" ", F.concat(F.col("dump_id").cast("string"), F.lit(";")), F.col("catoid").cast("string"), F.col("oid").cast("string"), "description", "restore_list_name")
    return entries.select("dump_id", F.concat(F.when(F.col("filtered"), ";").otherwise(""), text).alias("line"))


def extension_requirements(spark: SparkSession, text: str) -> DataFrame:
    """(name, version): versions that extensions must have, of a JSON list."""
    x = spark.createDataFrame([(text,)], "j string")
    return x.select(F.inline(F.from_json("j", "array<struct<name:string,version:string>>")))


def publication(name: str, selected: DataFrame) -> str:
    """The statement that publishes the selected tables (nspname, relname): a rule file's selection, on the source's side."""
    from lakeshift.functions.text import qualified, quote_always

    rows = selected.select(qualified(F.col("nspname"), F.col("relname")).alias("q")).orderBy("q").collect()  # a catalog's names
    head = selected.sparkSession.range(1).select(quote_always(F.lit(name))).first()[0]
    return f"CREATE PUBLICATION {head} FOR TABLE {', '.join(r.q for r in rows)}" if rows else f"CREATE PUBLICATION {head}"
