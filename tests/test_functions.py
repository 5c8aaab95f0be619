import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeshift.functions import text
from lakeshift.functions.checksum import digest, table_checksum


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("n, pretty", [(0, "0 B"), (10239, "10239 B"), (10240, "10 kB"), (17179869184, "16 GB"), (5 * 1024**6, "5120 PB"), (5223 * 1024, "5223 kB")])
def test_pretty_bytes(spark, n, pretty):
    assert one(spark, text.pretty_bytes(F.lit(n))) == pretty


@pytest.mark.parametrize("ms, pretty", [(0, "  0ms"), (834, "834ms"), (1100, " 1s100"), (2728, " 2s728"), (12000, "12s"), (185000, " 3m05s"), (3_720_000, " 1h02m"), (183_600_000, " 2d03h")])
def test_pretty_interval(spark, ms, pretty):
    assert one(spark, text.pretty_interval(F.lit(ms))) == pretty


@pytest.mark.parametrize("n, pretty", [(999, "999"), (49636, "49 636"), (1000, "1 000"), (1_234_000_000, "1234 million"), (1_000_000, "1000 thousands")])
def test_pretty_count(spark, n, pretty):
    assert one(spark, text.pretty_count(F.lit(n))) == pretty


def test_rate_of_no_time(spark):
    assert one(spark, text.pretty_rate(F.lit(5), F.lit(0))) == "0 B/s"
    assert one(spark, text.pretty_rate(F.lit(1_250_000), F.lit(1000))) == "10 MBit/s"


def test_positions(spark):
    assert one(spark, text.lsn_parse(F.lit("6F/140005C0"))) == (0x6F << 32) + 0x140005C0
    assert one(spark, text.lsn_parse(F.lit("6F-14"))) is None
    assert one(spark, text.lsn_format(F.lit(0x6F140005C0), True)) == "0000006F/140005C0"
    assert one(spark, text.lsn_format(F.lit(0x6F00000001))) == "6F/1"


@given(st.text(st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=12))
@settings(max_examples=25, deadline=None)
def test_quotes_round_trip(spark, name):
    quoted = one(spark, text.quote_always(F.lit(name)))
    if name:
        assert duckdb.sql(f"SELECT 1 AS {quoted}").columns == [name]
    assert one(spark, text.quote_literal(F.lit(name))) == "'" + name.replace("'", "''") + "'"


@pytest.mark.parametrize("pattern, yes, no", [("[[:digit:]]+x", "12x", "x"), ("^t[^]a]b", "tcb", "tab"), ("[]x]", "]", "y"), ("\\mfoo", "a foo", "afoo"), ("a.c", "xabcx", "ac"), ("^[[:alpha:]_][[:alnum:]_]*$", "a_1", "1a")])
def test_posix_regex(spark, pattern, yes, no):
    java = text.posix_regex(pattern)
    assert one(spark, F.lit(yes).rlike(java)) and not one(spark, F.lit(no).rlike(java))


def test_checksum_is_of_rows_not_of_their_order(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, None), (2, None, None)], "a int, b string, c double")
    first = table_checksum(df).first()
    assert first == table_checksum(df.orderBy(F.desc("a"))).first()
    assert first != table_checksum(df.distinct()).first()
    assert table_checksum(df.fillna({"b": ""})).first() != first
    assert table_checksum(df.limit(0)).first().checksum == one(spark, F.sha2(F.lit("-0"), 256)) == one(spark, digest(F.lit(None).cast("long"), F.lit(0)))
    assert table_checksum(df, []).first() == (3, "0")
