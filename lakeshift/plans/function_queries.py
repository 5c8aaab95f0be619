"""Queries of scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.functions import text
from lakeshift.plans.frames import table
from lakeshift.plans.registry import query


def ladder_sql(x: str, base: int, most: int, units: list[str]) -> str:
    cases = " ".join(f"WHEN {x} / {float(base**k)!r} < {most} THEN CAST(CAST(floor({x} / {float(base**k)!r}) AS BIGINT) AS VARCHAR) || ' {u}'" for k, u in enumerate(units[:-1]))
    return f"CASE {cases} ELSE CAST(CAST(floor({x} / {float(base ** (len(units) - 1))!r}) AS BIGINT) AS VARCHAR) || ' {units[-1]}' END"


_SIZES = "SELECT o_orderkey AS k, CAST(round(o_totalprice) AS BIGINT) * (1 + o_orderkey % 7) * CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 WHEN 3 THEN 1000000000 ELSE 3 END AS n FROM orders"


def sizes(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    scale = F.when(k % 5 == 0, 1).when(k % 5 == 1, 1000).when(k % 5 == 2, 1_000_000).when(k % 5 == 3, 1_000_000_000).otherwise(3)
    return table(spark, sf_dir, "orders").select(k.alias("k"), (F.round("o_totalprice").cast("long") * (1 + k % 7) * scale).cast("long").alias("n"))


@query(f"SELECT k, {ladder_sql('CAST(n AS DOUBLE)', 1024, 10240, text.BYTE_UNITS)} AS pretty FROM ({_SIZES})")
def pretty_bytes(spark, sf_dir) -> DataFrame:
    return sizes(spark, sf_dir).select("k", text.pretty_bytes(F.col("n")).alias("pretty"))


_COUNTS = ladder_sql("CAST(n AS DOUBLE)", 1000, 10000, text.COUNT_NAMES)


@query(f"SELECT k, CASE WHEN n < 1000 THEN CAST(n AS VARCHAR) WHEN n < 1000000 THEN CAST(n // 1000 AS VARCHAR) || ' ' || lpad(CAST(n % 1000 AS VARCHAR), 3, '0') ELSE {_COUNTS} END AS pretty FROM (SELECT k, n // (1 + k % 3 * 5000) AS n FROM ({_SIZES}))")
def pretty_count(spark, sf_dir) -> DataFrame:
    n = F.floor(F.expr("n div (1 + k % 3 * 5000)")).cast("long")
    return sizes(spark, sf_dir).select("k", n.alias("n")).select("k", text.pretty_count(F.col("n")).alias("pretty"))


_RATE = ladder_sql("(CAST(n AS DOUBLE) * 8000.0 / CAST(ms AS DOUBLE))", 1000, 10000, text.RATE_UNITS)


@query(f"SELECT k, CASE WHEN ms = 0 THEN '0 B/s' ELSE {_RATE} END AS pretty FROM (SELECT k, n, k % 97 * 10 AS ms FROM ({_SIZES}))")
def pretty_rate(spark, sf_dir) -> DataFrame:
    return sizes(spark, sf_dir).select("k", text.pretty_rate(F.col("n"), F.col("k") % 97 * 10).alias("pretty"))


@query("""
WITH m AS (SELECT o_orderkey AS k, CAST(round(o_totalprice) AS BIGINT) * CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 20 WHEN 2 THEN 700 ELSE 0 END + o_orderkey % 1500 AS ms FROM orders), s AS (SELECT k, ms, ms // 1000 AS s FROM m)
SELECT k, CASE WHEN ms < 1000 THEN lpad(CAST(ms AS VARCHAR), 3, ' ') || 'ms' WHEN s < 10 THEN lpad(CAST(s AS VARCHAR), 2, ' ') || 's' || lpad(CAST(ms % 1000 AS VARCHAR), 3, '0') WHEN s < 60 THEN lpad(CAST(s AS VARCHAR), 2, ' ') || 's'
  WHEN s < 3600 THEN lpad(CAST(s // 60 AS VARCHAR), 2, ' ') || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' WHEN s < 86400 THEN lpad(CAST(s // 3600 AS VARCHAR), 2, ' ') || 'h' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm'
  WHEN s < 864000 THEN lpad(CAST(s // 86400 AS VARCHAR), 2, ' ') || 'd' || lpad(CAST(s % 86400 // 3600 AS VARCHAR), 2, '0') || 'h' ELSE CAST(s // 86400 AS VARCHAR) || 'd' || lpad(CAST(s % 86400 // 3600 AS VARCHAR), 2, '0') || 'h' END AS pretty FROM s""")
def pretty_interval(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    scale = F.when(k % 4 == 0, 1).when(k % 4 == 1, 20).when(k % 4 == 2, 700).otherwise(0)
    ms = (F.round("o_totalprice").cast("long") * scale + k % 1500).cast("long")
    return table(spark, sf_dir, "orders").select(k.alias("k"), ms.alias("ms")).select("k", text.pretty_interval(F.col("ms")).alias("pretty"))


@query("""
WITH e AS (SELECT event_id AS id, event_id * 123457 + 1 AS lsn FROM events)
SELECT id, lsn, printf('%X', lsn >> 32) || '/' || printf('%X', lsn & 4294967295) AS lsn_text, printf('%08X', lsn >> 32) || '/' || printf('%08X', lsn & 4294967295) AS lsn_padded, lsn AS parsed FROM e""")
def lsn_parse_format(spark, sf_dir) -> DataFrame:
    x = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), (F.col("event_id") * 123457 + 1).alias("lsn"))
    x = x.withColumn("lsn_text", text.lsn_format(F.col("lsn"))).withColumn("lsn_padded", text.lsn_format(F.col("lsn"), True))
    return x.withColumn("parsed", text.lsn_parse(F.col("lsn_text")))


_NAMED = """SELECT c_custkey AS k, CASE c_custkey % 6 WHEN 0 THEN c_name WHEN 1 THEN lower(replace(c_name, '#', '_')) WHEN 2 THEN 'we"ird ' || CAST(c_custkey AS VARCHAR) WHEN 3 THEN 'user' WHEN 4 THEN '1st' ELSE 'it''s' END AS name FROM customer"""


def names(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    n = F.when(k % 6 == 0, F.col("c_name")).when(k % 6 == 1, F.lower(F.replace("c_name", F.lit("#"), F.lit("_")))).when(k % 6 == 2, F.concat(F.lit('we"ird '), k.cast("string"))).when(k % 6 == 3, "user").when(k % 6 == 4, "1st").otherwise("it's")
    return table(spark, sf_dir, "customer").select(k.alias("k"), n.alias("name"))


@query(f"""SELECT k, CASE WHEN regexp_full_match(name, '[a-z_][a-z0-9_$]*') AND name <> 'user' THEN name ELSE '"' || replace(name, '"', '""') || '"' END AS ident, '"' || replace(name, '"', '""') || '"' AS always, '''' || replace(name, '''', '''''') || '''' AS literal FROM ({_NAMED})""")
def quote_ident(spark, sf_dir) -> DataFrame:
    n = F.col("name")
    return names(spark, sf_dir).select("k", text.quote_ident(n).alias("ident"), text.quote_always(n).alias("always"), text.quote_literal(n).alias("literal"))


@query("SELECT k, CASE WHEN k % 4 = 3 THEN NULL ELSE n * CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 1024 ELSE 1073741824 END END AS bytes FROM (SELECT c_custkey AS k, c_custkey * 3 AS n FROM customer)")
def parse_bytes(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    unit = F.when(k % 4 == 0, "").when(k % 4 == 1, " kB").when(k % 4 == 2, "GB ").otherwise(" XB")
    return table(spark, sf_dir, "customer").select(k.alias("k"), text.parse_bytes(F.concat((k * 3).cast("string"), unit)).alias("bytes"))


_BOOLS = ["true", "T", "fal", "YES", "n", "on", "of", "o", "1", "0", "maybe", " off "]


@query("""SELECT c_custkey AS k, ['true', 'T', 'fal', 'YES', 'n', 'on', 'of', 'o', '1', '0', 'maybe', ' off '][c_custkey % 12 + 1] AS word,
  [true, true, false, true, false, true, false, NULL, true, false, NULL, false][c_custkey % 12 + 1] AS value FROM customer""")
def parse_bool(spark, sf_dir) -> DataFrame:
    word = F.get(F.array(*map(F.lit, _BOOLS)), (F.col("c_custkey") % 12).cast("int"))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), word.alias("word")).withColumn("value", text.parse_bool(F.col("word")))


@query("SELECT o_orderkey AS k, CASE WHEN v IS NULL THEN 'NULL' WHEN v % 1 = 0 THEN CAST(CAST(v AS BIGINT) AS VARCHAR) ELSE rtrim(printf('%.17f', v), '0') END AS number, CASE WHEN b IS NULL THEN 'NULL' WHEN b THEN 't' ELSE 'f' END AS flag FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey * 1.0 WHEN 1 THEN o_orderkey / 8.0 WHEN 2 THEN o_orderkey / -1024.0 END AS v, CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS b FROM orders)")
def value_text(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    v = F.when(k % 4 == 0, k.cast("double")).when(k % 4 == 1, k / 8.0).when(k % 4 == 2, k / -1024.0)
    b = F.when(k % 3 == 0, True).when(k % 3 == 1, False)
    return table(spark, sf_dir, "orders").select(k.alias("k"), v.alias("v"), b.alias("b")).select("k", text.number_text(F.col("v")).alias("number"), text.bool_text(F.col("b")).alias("flag"))


@query("SELECT k, a IS NOT DISTINCT FROM b AS same FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS a, CASE WHEN o_orderkey % 2 = 0 THEN 'F' END AS b FROM orders)")
def null_safe_equality(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    x = table(spark, sf_dir, "orders").select(k.alias("k"), F.when(k % 3 != 0, F.col("o_orderstatus")).alias("a"), F.when(k % 2 == 0, "F").alias("b"))
    return x.select("k", text.same_value(F.col("a"), F.col("b")).alias("same"))


@query("SELECT part, count(*) AS n FROM (SELECT unnest(string_split(p_type, ' ')) AS part FROM part) GROUP BY part")
def unnest_split(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.explode(F.split("p_type", " ")).alias("part")).groupBy("part").agg(F.count("*").alias("n"))


@query("SELECT n_nationkey, CAST(i AS INT) AS pos, x.a || '.' || x.b AS name FROM (SELECT n_nationkey, unnest(list_zip(['a', 'b', n_name], ['x', 'y', 'z'])) AS z, unnest([1, 2, 3]) AS i FROM nation) , LATERAL (SELECT z[1] AS a, z[2] AS b) x")
def paired_unnest(spark, sf_dir) -> DataFrame:
    x = table(spark, sf_dir, "nation").select("n_nationkey", F.posexplode(F.arrays_zip(F.array(F.lit("a"), F.lit("b"), F.col("n_name")).alias("a"), F.array(F.lit("x"), F.lit("y"), F.lit("z")).alias("b"))).alias("pos", "p"))
    return x.select("n_nationkey", (F.col("pos") + 1).alias("pos"), F.concat_ws(".", "p.a", "p.b").alias("name"))


@query("""SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'postgres://u' || CAST(c_custkey AS VARCHAR) || ':****@h/db' WHEN 1 THEN 'postgres://u@h' || CAST(c_custkey AS VARCHAR) || '/db'
  WHEN 2 THEN 'host=h password=**** user=u' || CAST(c_custkey AS VARCHAR) ELSE 'host=h PASSWORD=**** x=1' END AS uri FROM customer""")
def scrub_passwords(spark, sf_dir) -> DataFrame:
    k, c = F.col("c_custkey"), F.col("c_custkey").cast("string")
    uri = F.when(k % 4 == 0, F.concat(F.lit("postgres://u"), c, F.lit(":sec:ret"), c, F.lit("@h/db"))).when(k % 4 == 1, F.concat(F.lit("postgres://u@h"), c, F.lit("/db")))
    uri = uri.when(k % 4 == 2, F.concat(F.lit("host=h password=s3"), c, F.lit(" user=u"), c)).otherwise(F.concat(F.lit("host=h PASSWORD='a "), c, F.lit("' x=1")))
    return table(spark, sf_dir, "customer").select(k.alias("k"), text.scrubbed(uri).alias("uri"))


@query("SELECT c_custkey AS k, 'Customer%23' || substr(c_name, 10) || '%20%2F' AS uri FROM customer")
def percent_encode(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), text.percent_encoded(F.concat("c_name", F.lit(" /"))).alias("uri"))


@query("SELECT c_custkey AS k, regexp_matches(c_name, '[0-9]{2}7$') AS digits, regexp_matches(c_mktsegment, '^[A-H]') AS upper FROM customer")
def posix_match(spark, sf_dir) -> DataFrame:
    like = lambda c, p: F.col(c).rlike(text.posix_regex(p))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), like("c_name", "[[:digit:]]{2}7$").alias("digits"), like("c_mktsegment", "^[A-H]").alias("upper"))


@query("SELECT event_id, CAST(props->>'k' AS BIGINT) AS k, CAST(floor(epoch(ts)) AS BIGINT) AS epoch, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events")
def json_and_time(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.unix_timestamp("ts").alias("epoch"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"))


@query("SELECT n_nationkey AS k, n_nationkey % 3 = 0 OR n_nationkey % 3 = 1 AS blocked FROM nation")
def blocked_functions(spark, sf_dir) -> DataFrame:
    k = F.col("n_nationkey")
    names_ = F.when(k % 3 == 0, "int4send, bad_send").when(k % 3 == 1, "worse_send").otherwise("int4send, not_bad_send")
    return table(spark, sf_dir, "nation").select(k.alias("k"), text.blocked_function(names_, ["bad_send", "worse_send"]).alias("blocked"))
