"""Queries of lasting catalogs, listings, snapshots and clones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.operators import store
from lakeshift.plans.frames import shared_path, table
from lakeshift.plans.registry import query


@query("""
SELECT c_custkey AS oid, c_name AS relname, CASE WHEN c_custkey % 10 = 0 THEN 1 WHEN c_custkey % 3 = 0 THEN c_custkey * 2 ELSE c_nationkey END AS bytes,
  CASE WHEN c_custkey % 3 = 0 AND c_custkey % 10 <> 0 THEN 'changed' ELSE 'new' END AS state
FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey % 10 = 0""")
def catalog_store_upsert(spark, sf_dir) -> DataFrame:
    """Customers are tables of a catalog: added, some changed, some removed, some of these added again."""
    s = store.Store(spark, shared_path(spark, "store"))
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    rows = c.select(k.alias("oid"), F.col("c_name").alias("relname"), F.col("c_nationkey").cast("long").alias("bytes"), F.lit("new").alias("state"))
    s.add("s_table", rows)
    s.change("s_table", rows.where("oid % 3 = 0").select("oid", (F.col("oid") * 2).cast("long").alias("bytes"), F.lit("changed").alias("state")))
    s.remove("s_table", rows.where("oid % 5 = 0").select("oid"))
    s.add("s_table", rows.where("oid % 10 = 0").withColumn("bytes", F.lit(1).cast("long")))
    s.add_new("s_table", rows.where("oid % 10 <> 5").withColumn("bytes", F.lit(-1).cast("long")))  # all are there
    return s.state("s_table")


@query("SELECT s_nationkey AS tableoid, count(*) AS indexes, count(*) FILTER (WHERE s_suppkey % 2 = 0) AS constraints FROM supplier GROUP BY s_nationkey")
def catalog_store_batches(spark, sf_dir) -> DataFrame:
    """Indexes and constraints, each added in batches; all constraints were removed once and came back."""
    st = store.Store(spark, shared_path(spark, "store"))
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("oid"), F.col("s_nationkey").alias("tableoid"), F.col("s_name").alias("name"))
    for k in range(3):
        st.add("s_index", rows.where(F.col("oid") % 3 == k))
    st.add("s_constraint", rows)
    st.remove("s_constraint")
    st.add("s_constraint", rows.where("oid % 2 = 0"))
    c = st.catalog()
    n = c["s_constraint"].groupBy("tableoid").agg(F.count("*").alias("constraints"))
    return c["s_index"].groupBy("tableoid").agg(F.count("*").alias("indexes")).join(n, "tableoid", "left").na.fill(0, ["constraints"])


@query("""SELECT s_suppkey AS oid, s_nationkey AS tableoid, CASE WHEN s_suppkey % 4 > 0 THEN CAST(s_suppkey * 10 AS BIGINT) END AS duration_ms, s_suppkey % 4 > 0 AS done FROM supplier""")
def summary_of_indexes(spark, sf_dir) -> DataFrame:
    """Index builds that were begun, and those of them that have ended."""
    st = store.Store(spark, shared_path(spark, "store"))
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("oid"), F.col("s_nationkey").alias("tableoid"))
    st.started("index_summary", rows, at=100.0)
    st.finished("index_summary", rows.where("oid % 4 > 0").select("oid", (F.col("oid") * 10).cast("long").alias("duration_ms")), at=200.0)
    return st.state("index_summary").select("oid", "tableoid", "duration_ms", F.col("done_time").isNotNull().alias("done"))


@query("SELECT r_name AS datname, count(n_nationkey) AS tables, CAST(coalesce(sum(n_nationkey * 100), 0) AS BIGINT) AS bytes FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def list_databases(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return store.databases(n.select(F.col("r_name").alias("datname"), (F.col("n_nationkey") * 100).cast("long").alias("bytes")))


@query("""SELECT 'db' || CAST(n_regionkey AS VARCHAR) AS datname, n_name AS rolname, 'work_mem' AS name, CAST(n_nationkey AS VARCHAR) || 'MB' AS value FROM nation
UNION ALL SELECT 'db' || CAST(n_regionkey AS VARCHAR), n_name, 'search_path', 'a=b,' || n_name FROM nation WHERE n_nationkey % 2 = 0""")
def list_database_properties(spark, sf_dir) -> DataFrame:
    k = F.col("n_nationkey")
    mem, path = F.concat(F.lit("work_mem="), k.cast("string"), F.lit("MB")), F.concat(F.lit("search_path=a=b,"), F.col("n_name"))
    x = table(spark, sf_dir, "nation").select(F.concat(F.lit("db"), F.col("n_regionkey").cast("string")).alias("datname"), F.col("n_name").alias("rolname"), F.when(k % 2 == 0, F.array(mem, path)).otherwise(F.array(mem)).alias("setconfig"))
    return store.database_properties(x)


@query("SELECT s_suppkey AS oid, s_name AS rolname FROM supplier WHERE s_nationkey % 2 = 0")
def list_roles(spark, sf_dir) -> DataFrame:
    x = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("oid"), F.when(F.col("s_nationkey") % 2 == 0, F.col("s_name")).otherwise(F.concat(F.lit("pg_"), F.col("s_name"))).alias("rolname"))
    return store.roles(x)


@query("SELECT 'pinned' AS reader, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 'live', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders")
def snapshot_reads(spark, sf_dir) -> DataFrame:
    """A snapshot that was saved before more rows came, read after; and the table as it is."""
    path, o = shared_path(spark, "snapshot"), table(spark, sf_dir, "orders")
    o.where("o_orderkey % 3 = 0").write.parquet(f"{path}/orders")
    store.Snapshot.export(spark, {"orders": f"{path}/orders"}).save(f"{path}/note")
    o.where("o_orderkey % 3 <> 0").write.mode("append").parquet(f"{path}/orders")
    of = lambda name, df: df.agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")).select(F.lit(name).alias("reader"), "n", "keys")
    return of("pinned", store.Snapshot.load(spark, f"{path}/note").table("orders")).unionByName(of("live", spark.read.parquet(f"{path}/orders")))


@query(" UNION ALL ".join(f"SELECT 'db{k}' AS datname, '{t}' AS table_name, count(*) AS source_rows, count(*) AS target_rows, 'ok' AS status FROM {t} WHERE {c} % 2 = {k}" for k in (0, 1) for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"))))
def clone_all_databases(spark, sf_dir) -> DataFrame:
    """Two databases of two tables each, copied and compared."""
    of = lambda k: {t: table(spark, sf_dir, t).where(F.col(c) % 2 == k) for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"))}
    return store.clone_databases(spark, {f"db{k}": of(k) for k in (0, 1)}, shared_path(spark, "clone"))
