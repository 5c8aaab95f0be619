"""Queries of checksums, comparisons, splits and copies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.functions.checksum import table_checksum
from lakeshift.operators import compare, split
from lakeshift.operators.catalog import of_frames, unique_columns
from lakeshift.plans.frames import STAR, spread, table
from lakeshift.plans.registry import query

#: The columns of the tables with the kind of their canonical text: i as it is, d a double, t with microseconds.
COLUMNS = {
    "region": "r_regionkey:i r_name:i", "nation": "n_nationkey:i n_name:i n_regionkey:i",
    "customer": "c_custkey:i c_name:i c_nationkey:i c_acctbal:d c_mktsegment:i",
    "supplier": "s_suppkey:i s_name:i s_nationkey:i s_acctbal:d",
    "part": "p_partkey:i p_name:i p_brand:i p_type:i p_size:i p_retailprice:d",
    "orders": "o_orderkey:i o_custkey:i o_orderstatus:i o_totalprice:d o_orderdate:t o_orderpriority:i",
    "lineitem": "l_orderkey:i l_partkey:i l_suppkey:i l_linenumber:i l_quantity:d l_extendedprice:d l_discount:d l_tax:d l_returnflag:i l_linestatus:i l_shipdate:t",
}


def float_sql(x: str) -> str:
    """A double as checksum.float_text() writes it."""
    a = f"(CASE WHEN abs({x}) < 1e-290 THEN abs({x}) * pow(2.0, 200) ELSE abs({x}) END)"
    e = f"CAST(floor(log2({a})) AS INT)"
    m = f"({a} / pow(2.0, {e}))"
    e = f"({e} + CASE WHEN {m} >= 2 THEN 1 WHEN {m} < 1 THEN -1 ELSE 0 END)"
    text = f"CASE WHEN {x} < 0 THEN '-' ELSE '' END || CASE WHEN abs({x}) < 1e-290 THEN 's' ELSE '' END || CAST({e} AS VARCHAR) || ':' || CAST(CAST({a} / pow(2.0, {e}) * pow(2.0, 52) AS BIGINT) AS VARCHAR)"
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN 'nan' WHEN isinf({x}) THEN CASE WHEN {x} < 0 THEN '-inf' ELSE 'inf' END WHEN {x} = 0 THEN '0' ELSE {text} END"


def text_sql(column: str) -> str:
    name, kind = column.split(":")
    text = {"i": f"CAST({name} AS VARCHAR)", "d": float_sql(name), "t": f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')"}[kind]
    return f"coalesce(CAST(length({text}) AS VARCHAR) || ':' || {text}, 'N')"


def checksum_sql(name: str, source: str | None = None, columns: str | None = None) -> str:
    row = " || ".join(map(text_sql, (columns or COLUMNS[name]).split()))
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count,
      sha256(coalesce(CAST(sum(CAST('0x' || substr(md5({row}), 1, 8) AS BIGINT)) AS VARCHAR), '') || '-' || CAST(count(*) AS VARCHAR)) AS checksum
      FROM {source or name}"""


@query(" UNION ALL ".join(checksum_sql(t) for t in STAR))
def checksum_all_tables(spark, sf_dir) -> DataFrame:
    return compare.checksums({t: spread(table(spark, sf_dir, t)) for t in STAR}, portable=True)


@query(checksum_sql("orders", "(SELECT * FROM orders WHERE false)"))
def checksum_empty_table(spark, sf_dir) -> DataFrame:
    return compare.checksums({"orders": table(spark, sf_dir, "orders").where(F.lit(False))}, portable=True)


@query("SELECT '0' AS checksum, count(*) AS row_count FROM nation")
def checksum_no_columns(spark, sf_dir) -> DataFrame:
    return table_checksum(table(spark, sf_dir, "nation"), []).select("checksum", "row_count")


@query(f"""
WITH a AS ({checksum_sql("orders")} UNION ALL {checksum_sql("customer")} UNION ALL {checksum_sql("nation")} UNION ALL {checksum_sql("region")}),
b AS (
  {checksum_sql("orders", "(SELECT * FROM orders WHERE o_orderkey % 100 <> 7)")}
  UNION ALL {checksum_sql("customer", "(SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 50 = 3 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer)")}
  UNION ALL {checksum_sql("nation")})
SELECT a.table_name, a.row_count AS source_rows, b.row_count AS target_rows, a.checksum AS source_checksum, b.checksum AS target_checksum,
  CASE WHEN b.row_count IS NULL THEN 'missing' WHEN a.row_count <> b.row_count THEN 'rows' WHEN a.checksum <> b.checksum THEN 'checksum' ELSE 'ok' END AS status
FROM a LEFT JOIN b ON a.table_name = b.table_name""")
def compare_data_mutated(spark, sf_dir) -> DataFrame:
    source = {t: table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region")}
    changed = F.when(F.col("c_custkey") % 50 == 3, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    target = {"orders": source["orders"].where("o_orderkey % 100 <> 7"), "customer": source["customer"].withColumn("c_acctbal", changed), "nation": source["nation"]}
    return compare.compare_data(source, target, portable=True)


#: Customers whose balances and names take forms that a careless checksum takes for others.
_ODD = "c_custkey, CASE c_custkey % 7 WHEN 0 THEN c_acctbal + {d} WHEN 1 THEN {n}::DOUBLE WHEN 2 THEN 1e300 * {s} WHEN 3 THEN 5e-324 * {s} WHEN 4 THEN NULL ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN {a} ELSE c_name END AS c_name, CASE WHEN c_custkey % 3 = 0 THEN {b} ELSE c_mktsegment END AS c_mktsegment"
_ODD_SIDES = {
    "hundredths": ({"d": "0.001"}, {"d": "0.004"}), "nan": ({"n": "'nan'"}, {"n": "'inf'"}), "large": ({"s": "1"}, {"s": "2"}), "bars": ({"a": "'a|b'", "b": "'c'"}, {"a": "'a'", "b": "'b|c'"}),
    "nulls": ({"a": "NULL"}, {"a": "'~N'"}), "moved_null": ({"a": "NULL", "b": "'x'"}, {"a": "'x'", "b": "NULL"}), "same": ({}, {}),
}


def _odd_sql(values: dict) -> str:
    return "SELECT " + _ODD.format(**{"d": "0", "n": "'nan'", "s": "1", "a": "c_name", "b": "c_mktsegment"} | values) + " FROM customer"


_ODD_COLUMNS = "c_custkey:i c_acctbal:d c_name:i c_mktsegment:i"


@query(" UNION ALL ".join(f"""SELECT a.table_name, a.row_count AS source_rows, b.row_count AS target_rows, a.checksum AS source_checksum, b.checksum AS target_checksum, CASE WHEN a.checksum <> b.checksum THEN 'checksum' ELSE 'ok' END AS status
FROM ({checksum_sql(n, f"({_odd_sql(a)})", _ODD_COLUMNS)}) a, ({checksum_sql(n, f"({_odd_sql(b)})", _ODD_COLUMNS)}) b""" for n, (a, b) in _ODD_SIDES.items()))
def compare_data_small_changes(spark, sf_dir) -> DataFrame:
    """Differences below a hundredth, in the last bits, of separators in texts, and of nulls."""
    table(spark, sf_dir, "customer").createOrReplaceTempView("_odd_customer")
    side = lambda v: spark.sql(_odd_sql(v).replace("::DOUBLE", "D").replace("'nan'D", "double('NaN')").replace("'inf'D", "double('Infinity')").replace("FROM customer", "FROM _odd_customer"))
    return compare.compare_data({n: side(a) for n, (a, _) in _ODD_SIDES.items()}, {n: side(b) for n, (_, b) in _ODD_SIDES.items()}, portable=True)


@query("""
WITH a AS (SELECT table_name AS relname, column_name AS attname, data_type AS typname FROM information_schema.columns WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem')),
b AS (SELECT relname, attname, CASE WHEN attname = 'c_acctbal' THEN 'x' ELSE typname END AS typname FROM a WHERE attname NOT IN ('o_orderdate', 'p_size') AND relname <> 'region'),
ca AS (SELECT relname, count(*) AS n FROM a GROUP BY relname), cb AS (SELECT relname, count(*) AS n FROM b GROUP BY relname)
SELECT 'table' AS kind, 'public.' || relname AS object, 'missing' AS difference FROM ca WHERE relname NOT IN (SELECT relname FROM cb)
UNION ALL
SELECT 'column', 'public.' || a.relname || '.' || a.attname, CASE WHEN b.attname IS NULL THEN 'missing' ELSE 'typname' END
FROM a LEFT JOIN b ON a.relname = b.relname AND a.attname = b.attname WHERE b.attname IS NULL OR a.typname <> b.typname
UNION ALL
SELECT 'columns', 'public.' || ca.relname, ca.n || ' <> ' || coalesce(cb.n, 0) FROM ca LEFT JOIN cb ON ca.relname = cb.relname WHERE ca.n <> coalesce(cb.n, 0)""")
def compare_schema_columns(spark, sf_dir) -> DataFrame:
    """The tables' own schemas against tables without one of them and some columns, and with another type."""
    tables = {t: table(spark, sf_dir, t) for t in STAR}
    changed = {t: df.drop("o_orderdate", "p_size") for t, df in tables.items() if t != "region"}
    changed["customer"] = changed["customer"].withColumn("c_acctbal", F.col("c_acctbal").cast("string"))
    of = lambda x: {"s_table": x["s_table"].select("nspname", "relname"), "s_attr": x["s_attr"]}
    return compare.compare_schemas(of(of_frames(spark, tables)), of(of_frames(spark, changed)))


@query("""
WITH a AS (SELECT 'seq_' || CAST(n_nationkey AS VARCHAR) AS relname, n_nationkey * 10 AS v, n_nationkey % 2 = 0 AS called FROM nation),
b AS (SELECT relname, CASE WHEN v % 70 = 0 THEN v + 1 ELSE v END AS v, called FROM a WHERE v % 110 <> 0)
SELECT 'sequence' AS kind, 's.' || a.relname AS object, CASE WHEN b.relname IS NULL THEN 'missing' ELSE 'last_value' END AS difference
FROM a LEFT JOIN b ON a.relname = b.relname WHERE b.relname IS NULL OR a.v <> b.v""")
def compare_sequences(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    a = n.select(F.lit("s").alias("nspname"), F.concat(F.lit("seq_"), F.col("n_nationkey").cast("string")).alias("relname"), (F.col("n_nationkey") * 10).alias("last_value"), (F.col("n_nationkey") % 2 == 0).alias("is_called"))
    b = a.where("last_value % 110 <> 0").withColumn("last_value", F.when(F.col("last_value") % 70 == 0, F.col("last_value") + 1).otherwise(F.col("last_value")))
    return compare.compare_objects(a, b, ["nspname", "relname"], ["last_value", "is_called"], "sequence")


@query("""
WITH o AS (SELECT c_mktsegment AS datname, CASE WHEN c_nationkey % 2 = 0 THEN 'table' ELSE 'index' END AS kind, CASE WHEN c_custkey % 3 = 0 THEN 'target' ELSE 'source' END AS side FROM customer)
SELECT datname, kind, count(*) FILTER (WHERE side = 'source') AS source, count(*) FILTER (WHERE side = 'target') AS target FROM o GROUP BY datname, kind""")
def object_counts_by_side(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return compare.counts_by_side(c.select(F.col("c_mktsegment").alias("datname"), F.when(F.col("c_nationkey") % 2 == 0, "table").otherwise("index").alias("kind"), F.when(F.col("c_custkey") % 3 == 0, "target").otherwise("source").alias("side")))


def plan_sql(name: str, key: str, size: int, part: int, most: int = 0) -> str:
    cap = f"least(n, {most})" if most else "n"
    return f"""
WITH b AS (SELECT min({key}) AS lo, max({key}) AS hi, CAST(ceil({size}.0 / {part}) AS BIGINT) + 1 AS n FROM {name}),
p AS (SELECT lo, hi, {cap} AS n, CAST(ceil((hi - lo + 1) * 1.0 / {cap}) AS BIGINT) AS w FROM b)
SELECT '{name}' AS table_name, CAST(i AS INT) AS partnum, CAST(n AS INT) AS partcount, CASE WHEN i > 1 THEN lo + (i - 2) * w END AS lo,
  CASE WHEN i > 1 AND i < n THEN lo + (i - 1) * w - 1 END AS hi, i = 1 AS is_null_part
FROM (SELECT p.*, unnest(generate_series(1, n)) AS i FROM p)"""


@query(" UNION ALL ".join(f"({plan_sql(*x)})" for x in (("orders", "o_orderkey", 102400, 10240), ("customer", "c_custkey", 51200, 10240), ("part", "p_partkey", 99999, 7000))))
def split_plan_integer_key(spark, sf_dir) -> DataFrame:
    plans = [split.plan_key_split(table(spark, sf_dir, t), t, k, b, p) for t, k, b, p in (("orders", "o_orderkey", 102400, 10240), ("customer", "c_custkey", 51200, 10240), ("part", "p_partkey", 99999, 7000))]
    return reduce(DataFrame.unionByName, plans)


@query(plan_sql("orders", "o_orderkey", 102400, 10240, 3))
def split_plan_max_parts(spark, sf_dir) -> DataFrame:
    return split.plan_key_split(table(spark, sf_dir, "orders"), "orders", "o_orderkey", 102400, 10240, 3)


def _nullable(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("k", F.when(F.col("l_linenumber") != 3, F.col("l_orderkey")))


_PARTS = plan_sql("k", "k", 50000, 5000)


@query(f"""
WITH k AS (SELECT CASE WHEN l_linenumber <> 3 THEN l_orderkey END AS k, l_quantity FROM lineitem), parts AS ({_PARTS})
SELECT p.partnum, count(*) AS n_rows, CAST(sum(l_quantity) AS BIGINT) AS quantity
FROM k JOIN parts p ON CASE WHEN p.is_null_part THEN k IS NULL WHEN p.hi IS NULL THEN k >= p.lo ELSE k BETWEEN p.lo AND p.hi END GROUP BY p.partnum""")
def split_null_part(spark, sf_dir) -> DataFrame:
    df = _nullable(spark, sf_dir)
    parts = split.key_parts(50000, 5000, *split.key_bounds(df, "k"))
    return df.withColumn("partnum", split.part_of(F.col("k"), parts)).groupBy("partnum").agg(F.count("*").alias("n_rows"), F.sum("l_quantity").cast("long").alias("quantity"))


@query(f"""
WITH parts AS ({plan_sql("orders", "o_orderkey", 40000, 10000)})
SELECT p.partnum, count(o_orderkey) AS n_rows, CAST(round(sum(o_totalprice * 100)) AS BIGINT) // 1000 AS thousands
FROM parts p LEFT JOIN orders ON CASE WHEN p.is_null_part THEN o_orderkey IS NULL WHEN p.hi IS NULL THEN o_orderkey >= p.lo ELSE o_orderkey BETWEEN p.lo AND p.hi END
GROUP BY p.partnum HAVING count(o_orderkey) > 0""")
def split_scan_counts(spark, sf_dir) -> DataFrame:
    """Each part is a scan of its own with its range pushed down."""
    df = table(spark, sf_dir, "orders")
    parts = split.key_parts(40000, 10000, *split.key_bounds(df, "o_orderkey"))
    x = split.scan_all(df, parts, "o_orderkey", ["o_orderkey", "o_totalprice"])
    return x.groupBy("partnum").agg(F.count("*").alias("n_rows"), F.floor(F.round(F.sum(F.col("o_totalprice") * 100)) / 1000).cast("long").alias("thousands"))


@query("""
WITH n AS (SELECT CAST(ceil(count(*) / 100.0) AS BIGINT) AS pages FROM lineitem),
c AS (SELECT pages, CAST(ceil(pages / 4.0) AS BIGINT) AS parts FROM n), w AS (SELECT pages, parts, CAST(ceil(pages * 1.0 / parts) AS BIGINT) AS w FROM c)
SELECT 'lineitem' AS table_name, CAST(i AS INT) AS partnum, CAST(parts AS INT) AS partcount, CASE WHEN parts > 1 THEN (i - 1) * w END AS lo, CASE WHEN i < parts THEN i * w - 1 END AS hi, false AS is_null_part
FROM (SELECT w.*, unnest(generate_series(1, parts)) AS i FROM w)""")
def split_page_plan(spark, sf_dir) -> DataFrame:
    pages = -(-table(spark, sf_dir, "lineitem").count() // 100)
    return split.as_frame(spark, "lineitem", split.page_parts(pages, 4 * 8192))


@query("""
SELECT t AS table_name, bytes, CASE WHEN bytes < 10000 THEN 'none' WHEN k IS NOT NULL THEN 'key' ELSE 'pages' END AS method
FROM (SELECT 'nation' AS t, count(*) * 100 AS bytes, 'n_nationkey' AS k FROM nation UNION ALL SELECT 'orders', count(*) * 100, 'o_orderkey' FROM orders UNION ALL SELECT 'lineitem', count(*) * 100, NULL FROM lineitem)""")
def split_eligibility(spark, sf_dir) -> DataFrame:
    rows = []
    for t, k in (("nation", "n_nationkey"), ("orders", "o_orderkey"), ("lineitem", None)):
        size = 100 * table(spark, sf_dir, t).count()
        rows.append((t, size, split.split_method(size, 10000, k)))
    return spark.createDataFrame(rows, "table_name string, bytes long, method string")


_UNIQUE = {"orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_linenumber"], "customer": ["c_custkey", "c_nationkey"]}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n, count(DISTINCT {c}) AS n_distinct, count(*) - count({c}) AS n_null, count({c}) = count(DISTINCT {c}) AS is_unique FROM {t}" for t, cs in _UNIQUE.items() for c in cs))
def key_uniqueness(spark, sf_dir) -> DataFrame:
    return reduce(DataFrame.unionByName, [unique_columns(table(spark, sf_dir, t), cs).select(F.lit(t).alias("table_name"), "*") for t, cs in _UNIQUE.items()])


@query("SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL HAVING count(*) > 1")
def unique_violations(spark, sf_dir) -> DataFrame:
    from lakeshift.operators.catalog import violated

    return violated(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"])
