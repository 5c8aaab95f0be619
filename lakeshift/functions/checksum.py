"""Order-insensitive checksums of tables: the digest of the sum of the rows' hashes and their count.

The native form hashes typed columns with xxhash64 and stays in generated code; a bitmap of the nulls takes part, as the
hash passes over them. The portable form can be computed by other engines: md5 of the columns' texts, each with its
length before it, of which the first eight hexadecimal digits are summed. Both tell any two different rows apart but for
collisions of the hash: numbers keep all their bits (only -0 is 0, and all NaN are one), nulls are no text, and no text
of a column can pass for two. Both are one pass over the needed columns with partial sums, however large the table is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def float_text(x: Column) -> Column:
    """A finite double as sign, exponent and 53 bits of mantissa, exactly; others by name.

    Scaling by powers of two is exact; the exponent that a logarithm gives is put right where it is one off, and numbers
    near the least are scaled up first ("s").
    """
    a = F.abs(x)
    tiny = a < F.lit(1e-290)
    a = F.when(tiny, a * F.lit(2.0**200)).otherwise(a)
    e = F.floor(F.log2(a))
    m = a / F.pow(F.lit(2.0), e)
    e = F.when(m >= 2, e + 1).when(m < 1, e - 1).otherwise(e)
    bits = (a / F.pow(F.lit(2.0), e) * F.lit(2.0**52)).cast("long").cast("string")
    text = F.concat(F.when(x < 0, "-").otherwise(""), F.when(tiny, "s").otherwise(""), e.cast("string"), F.lit(":"), bits)
    return F.when(F.isnan(x), "nan").when(a == float("inf"), F.when(x < 0, "-inf").otherwise("inf")).when(x == 0, "0").otherwise(text)


def canonical(column: Column, kind: T.DataType) -> Column:
    """A text that other engines make as well."""
    if isinstance(kind, T.FloatType | T.DoubleType):
        return float_text(column.cast("double"))
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.hex(column) if isinstance(kind, T.BinaryType) else column.cast("string")


def row_text(df: DataFrame, columns: list[str] | None = None) -> Column:
    """All columns, each as its length and its text, nulls as "N"."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = [canonical(F.col(f"`{c}`"), kinds[c]) for c in columns or df.columns]
    return F.concat(*[F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("N")) for t in texts])


def digest(total: Column, count: Column) -> Column:
    """sha256 of "sum-count"; the sum of no rows is the empty text."""
    return F.sha2(F.concat(F.coalesce(total.cast("string"), F.lit("")), F.lit("-"), count.cast("string")), 256)


def portable_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    return F.conv(F.substring(F.md5(row_text(df, columns).cast("binary")), 1, 8), 16, 10).cast("decimal(20,0)")


def native_hash(columns: list[str]) -> Column:
    """xxhash64 of the nulls' bitmap and the columns."""
    names = [F.col(f"`{c}`") for c in columns]
    maps = [reduce(Column.__add__, [F.when(c.isNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, c in enumerate(names[at : at + 60])]) for at in range(0, len(names), 60)]
    return F.xxhash64(*maps, *names)


def table_checksum(df: DataFrame, columns: list[str] | None = None, portable: bool = True) -> DataFrame:
    """(row_count, checksum) of a table, over the listed columns; a table without columns has the checksum "0"."""
    columns = df.columns if columns is None else columns
    if not columns:
        return df.agg(F.count("*").alias("row_count")).withColumn("checksum", F.lit("0"))
    if portable:
        total = F.sum(portable_hash(df, columns))
    else:
        # sums of three parts of the hash are long, and enough for 2^41 rows
        df = df.select(native_hash(columns).alias("h"))
        part = lambda shift, bits: F.sum(F.shiftrightunsigned("h", shift).bitwiseAND(F.lit((1 << bits) - 1))).cast("string")
        total = F.concat_ws(",", part(0, 22), part(22, 21), part(43, 21))
    return df.agg(F.count("*").alias("row_count"), total.alias("total")).select("row_count", digest(F.col("total"), F.col("row_count")).alias("checksum"))
