"""Queries of catalogs, filters, dependencies, set operations and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.operators import catalog, depends, filters, progress
from lakeshift.plans.frames import STAR, table
from lakeshift.plans.registry import query
from lakeshift.sources.rules import parse_rules

#: Objects to select from: a schema for each region with a table for each nation, and one for each market segment with a
#: table for each customer.
OBJECTS_SQL = """objects AS (
  SELECT lower(r_name) AS nspname, lower(n_name) AS relname, CAST(n_nationkey AS BIGINT) AS oid FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'seg_' || lower(c_mktsegment), 'customer_' || CAST(c_custkey AS VARCHAR), c_custkey + 1000 FROM customer)"""


def objects(spark, sf_dir) -> DataFrame:
    n, r, c = (table(spark, sf_dir, t) for t in ("nation", "region", "customer"))
    a = n.join(r, n.n_regionkey == r.r_regionkey).select(F.lower("r_name").alias("nspname"), F.lower("n_name").alias("relname"), F.col("n_nationkey").cast("long").alias("oid"))
    b = c.select(F.concat(F.lit("seg_"), F.lower("c_mktsegment")).alias("nspname"), F.concat(F.lit("customer_"), F.col("c_custkey").cast("string")).alias("relname"), (F.col("c_custkey") + 1000).alias("oid"))
    return a.unionByName(b)


def _selected(rules: str, complement: bool = False):
    def run(spark, sf_dir) -> DataFrame:
        return filters.select_tables(objects(spark, sf_dir), parse_rules(rules), complement=complement)

    return run


FILTERS = {
    "filter_include_exact": ("[include-only-table]\nasia.nation_1\nseg_building.customer_1\nseg_building.customer_7\n", "(nspname, relname) IN (('asia', 'nation_1'), ('seg_building', 'customer_1'), ('seg_building', 'customer_7'))", "false"),
    "filter_include_regex_table": ("[include-only-table]\nseg_building.~/_[[:digit:]]$/\nseg_machinery.~/_2.$/\n", "nspname = 'seg_building' AND regexp_matches(relname, '_[0-9]$') OR nspname = 'seg_machinery' AND regexp_matches(relname, '_2.$')", "false"),
    "filter_include_regex_schema": ("[include-only-table]\n~/^seg_[a-h]/.customer_12\n~{^a}.nation_3\n", "regexp_matches(nspname, '^seg_[a-h]') AND relname = 'customer_12' OR regexp_matches(nspname, '^a') AND relname = 'nation_3'", "false"),
    "filter_include_regex_both": ("[include-only-table]\n~/^seg/.~/1[[:digit:]]*5$/\n", "regexp_matches(nspname, '^seg') AND regexp_matches(relname, '1[0-9]*5$')", "false"),
    "filter_exclude": ("[exclude-schema]\nasia\n~/^seg_[m-z]/\n[exclude-table]\nseg_building.customer_1\nseg_automobile.~/_1/\n", "NOT (nspname = 'asia' OR regexp_matches(nspname, '^seg_[m-z]') OR nspname = 'seg_building' AND relname = 'customer_1' OR nspname = 'seg_automobile' AND regexp_matches(relname, '_1'))", "false"),
    "filter_exclude_data_flag": ("[exclude-table-data]\n~/^seg/.~/7$/\nasia.~/./\n", "true", "regexp_matches(nspname, '^seg') AND regexp_matches(relname, '7$') OR nspname = 'asia'"),
    "filter_include_schema": ("[include-only-schema]\neurope\n~/building$/\n", "nspname = 'europe' OR regexp_matches(nspname, 'building$')", "false"),
}
for _name, (_rules, _where, _flag) in FILTERS.items():
    for _part, _not in (("", ""), ("_complement", "NOT ")):
        _f = _selected(_rules, bool(_part))
        _f.__name__ = _name + _part
        query(f"WITH {OBJECTS_SQL} SELECT nspname, relname, oid, {_flag} AS exclude_data FROM objects WHERE {_not}({_where})")(_f)


@query(f"""WITH {OBJECTS_SQL} SELECT nspname, relname, oid FROM objects WHERE (nspname, relname) IN (('asia', 'nation_1'), ('seg_building', 'customer_7')) OR regexp_matches(nspname, '^seg_a') AND regexp_matches(relname, '9$') OR regexp_matches(relname, '_33$') AND nspname = 'seg_furniture'""")
def filter_rule_table(spark, sf_dir) -> DataFrame:
    rules = parse_rules("[include-only-table]\nasia.nation_1\nseg_building.customer_7\n~/^seg_a/.~/9$/\nseg_furniture.~/_33$/\n").frame(spark)
    return filters.rule_matches(objects(spark, sf_dir), rules, "include-only-table").select("nspname", "relname", "oid")


@query("""
WITH r AS (SELECT 's' || CAST(c_nationkey % 3 AS VARCHAR) AS section, CASE WHEN c_custkey % 2 = 0 THEN 'n' || CAST(c_nationkey AS VARCHAR) END AS nsp, CASE WHEN c_custkey % 2 = 1 THEN '^n' || CAST(c_nationkey AS VARCHAR) END AS nsp_re,
  CASE WHEN c_custkey % 3 > 0 THEN c_name END AS rel, CASE WHEN c_custkey % 3 = 0 THEN c_name || '$' END AS rel_re FROM customer)
SELECT section, coalesce(string_agg(nsp, ',' ORDER BY nsp, rel) FILTER (WHERE nsp IS NOT NULL AND rel IS NOT NULL), '') AS ee_nsp, coalesce(string_agg(rel, ',' ORDER BY nsp, rel) FILTER (WHERE nsp IS NOT NULL AND rel IS NOT NULL), '') AS ee_rel,
  coalesce(string_agg(nsp, ',' ORDER BY nsp, rel_re) FILTER (WHERE nsp IS NOT NULL AND rel_re IS NOT NULL), '') AS er_nsp, coalesce(string_agg(rel_re, ',' ORDER BY nsp, rel_re) FILTER (WHERE nsp IS NOT NULL AND rel_re IS NOT NULL), '') AS er_rel,
  coalesce(string_agg(nsp_re, ',' ORDER BY nsp_re, rel) FILTER (WHERE nsp_re IS NOT NULL AND rel IS NOT NULL), '') AS re_nsp, coalesce(string_agg(rel, ',' ORDER BY nsp_re, rel) FILTER (WHERE nsp_re IS NOT NULL AND rel IS NOT NULL), '') AS re_rel,
  coalesce(string_agg(nsp_re, ',' ORDER BY nsp_re, rel_re) FILTER (WHERE nsp_re IS NOT NULL AND rel_re IS NOT NULL), '') AS rr_nsp, coalesce(string_agg(rel_re, ',' ORDER BY nsp_re, rel_re) FILTER (WHERE nsp_re IS NOT NULL AND rel_re IS NOT NULL), '') AS rr_rel
FROM r GROUP BY section""")
def filter_rule_arrays(spark, sf_dir) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    rules = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("s"), (F.col("c_nationkey") % 3).cast("string")).alias("section"), F.when(k % 2 == 0, F.concat(F.lit("n"), n)).alias("nspname"), F.when(k % 2 == 1, F.concat(F.lit("^n"), n)).alias("nspname_re"),
        F.when(k % 3 > 0, F.col("c_name")).alias("relname"), F.when(k % 3 == 0, F.concat("c_name", F.lit("$"))).alias("relname_re"),
    )
    return filters.rule_arrays(rules)


@query("""
SELECT CAST(1 AS BIGINT) AS catoid, CAST(r_regionkey AS BIGINT) AS oid, r_name AS restore_list_name, 'schema' AS kind FROM region
UNION ALL SELECT 2, n_nationkey, n_name, 'table' FROM nation WHERE n_regionkey < 3 UNION ALL SELECT 3, s_suppkey, s_name, 'index' FROM supplier WHERE s_acctbal < 0
UNION ALL SELECT 4, n_nationkey, n_name, 'constraint' FROM nation WHERE n_regionkey = 4""")
def filter_union_materialise(spark, sf_dir) -> DataFrame:
    r, n, s = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    named = lambda df, o, m: df.select(F.col(o).cast("long").alias("oid"), F.col(m).alias("restore_list_name"))
    return filters.filtered_objects({"schema": (1, named(r, "r_regionkey", "r_name")), "table": (2, named(n.where("n_regionkey < 3"), "n_nationkey", "n_name")), "index": (3, named(s.where("s_acctbal < 0"), "s_suppkey", "s_name")), "constraint": (4, named(n.where("n_regionkey = 4"), "n_nationkey", "n_name"))})


@query("""
WITH f AS (SELECT CAST(2 AS BIGINT) AS catoid, CAST(n_nationkey AS BIGINT) AS oid, n_name AS name FROM nation WHERE n_regionkey < 2),
i AS (SELECT CAST(n_nationkey % 3 AS BIGINT) AS catoid, CAST(CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE n_nationkey END AS BIGINT) AS oid, n_name AS name FROM nation)
SELECT i.catoid, i.oid, i.name AS restore_list_name, EXISTS (SELECT 1 FROM f WHERE f.oid > 0 AND f.catoid = i.catoid AND f.oid = i.oid) OR (i.catoid = 0 AND EXISTS (SELECT 1 FROM f WHERE f.oid > 0 AND f.oid = i.oid)) OR (i.oid = 0 AND EXISTS (SELECT 1 FROM f WHERE f.name = i.name)) AS filtered FROM i""")
def filter_object_lookup(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    f = n.where("n_regionkey < 2").select(F.lit(2).cast("long").alias("catoid"), F.col("n_nationkey").cast("long").alias("oid"), F.col("n_name").alias("restore_list_name"))
    i = n.select((F.col("n_nationkey") % 3).cast("long").alias("catoid"), F.when(F.col("n_nationkey") % 5 == 0, 0).otherwise(F.col("n_nationkey")).cast("long").alias("oid"), F.col("n_name").alias("restore_list_name"))
    return filters.is_filtered(i, f).select("catoid", "oid", "restore_list_name", "filtered")


@query("""
WITH s AS (SELECT n_nationkey AS oid, 'r' || CAST(n_regionkey AS VARCHAR) AS nspname, CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey * 2 END AS ownedby, CASE WHEN n_nationkey % 3 = 1 THEN n_nationkey * 3 END AS attrelid FROM nation),
t AS (SELECT c_custkey AS oid, 'r' || CAST(c_custkey % 3 AS VARCHAR) AS nspname FROM customer WHERE c_acctbal < 0)
SELECT oid, nspname, ownedby, attrelid FROM s WHERE ownedby IN (SELECT oid FROM t) OR attrelid IN (SELECT oid FROM t) OR (ownedby IS NULL AND attrelid IS NULL AND nspname IN (SELECT nspname FROM t))""")
def sequence_scope(spark, sf_dir) -> DataFrame:
    k = F.col("n_nationkey")
    s = table(spark, sf_dir, "nation").select(k.alias("oid"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("nspname"), F.when(k % 3 == 0, k * 2).alias("ownedby"), F.when(k % 3 == 1, k * 3).alias("attrelid"))
    t = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("oid"), F.concat(F.lit("r"), (F.col("c_custkey") % 3).cast("string")).alias("nspname"))
    return filters.sequences_in_scope(s, t)


#: Regions hold nations, nations customers and suppliers; every seventh edge is internal.
EDGES_SQL = """edges AS (
  SELECT 'r' || CAST(n_regionkey AS VARCHAR) AS src, 'n' || CAST(n_nationkey AS VARCHAR) AS dst, CASE WHEN n_nationkey % 7 = 0 THEN 'i' ELSE 'n' END AS deptype FROM nation
  UNION ALL SELECT 'n' || CAST(c_nationkey AS VARCHAR), 'c' || CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 7 = 0 THEN 'i' ELSE 'a' END FROM customer
  UNION ALL SELECT 'n' || CAST(s_nationkey AS VARCHAR), 's' || CAST(s_suppkey AS VARCHAR), 'n' FROM supplier)"""


def edges(spark, sf_dir) -> DataFrame:
    n, c, s = (table(spark, sf_dir, t) for t in ("nation", "customer", "supplier"))
    name = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string"))
    return (
        n.select(name("r", "n_regionkey").alias("src"), name("n", "n_nationkey").alias("dst"), F.when(F.col("n_nationkey") % 7 == 0, "i").otherwise("n").alias("deptype"))
        .unionByName(c.select(name("n", "c_nationkey").alias("src"), name("c", "c_custkey").alias("dst"), F.when(F.col("c_custkey") % 7 == 0, "i").otherwise("a").alias("deptype")))
        .unionByName(s.select(name("n", "s_nationkey").alias("src"), name("s", "s_suppkey").alias("dst"), F.lit("n").alias("deptype")))
    )


_CLOSURE = f"""WITH RECURSIVE {EDGES_SQL}, r AS (SELECT DISTINCT src AS root, src AS obj, 0 AS depth FROM edges UNION SELECT r.root, e.dst, r.depth + 1 FROM r JOIN edges e ON e.src = r.obj)
SELECT root, obj, CAST(min(depth) AS INT) AS depth FROM r GROUP BY root, obj"""


@query(_CLOSURE)
def depends_closure(spark, sf_dir) -> DataFrame:
    return depends.closure(edges(spark, sf_dir))


@query(_CLOSURE)
def depends_closure_recursive(spark, sf_dir) -> DataFrame:
    e = edges(spark, sf_dir)
    return depends.closure(e, e.select(F.col("src").alias("obj")), near=1)


#: Objects that own internal ones, and what they own in the end.
HELD_SQL = """held AS (
  SELECT DISTINCT e.src AS owner, e.src AS obj FROM edges e WHERE e.deptype = 'i' AND NOT EXISTS (SELECT 1 FROM edges x WHERE x.deptype = 'i' AND x.dst = e.src)
  UNION SELECT h.owner, e.dst FROM held h JOIN edges e ON e.src = h.obj AND e.deptype = 'i')"""


@query(f"""WITH RECURSIVE {EDGES_SQL}, {HELD_SQL}
SELECT DISTINCT obj FROM (SELECT unnest([src, dst]) AS obj FROM edges WHERE deptype <> 'i') WHERE obj NOT IN (SELECT owner FROM held)""")
def depends_roots_except(spark, sf_dir) -> DataFrame:
    return depends.outer_objects(edges(spark, sf_dir))


@query(f"""WITH RECURSIVE {EDGES_SQL}, {HELD_SQL},
ends AS (SELECT src, dst, deptype, unnest([src, dst]) AS obj, unnest([0, 1]) AS side FROM edges WHERE deptype <> 'i'),
named AS (SELECT ends.*, coalesce(owner, ends.obj) AS name FROM ends LEFT JOIN held ON held.obj = ends.obj)
SELECT DISTINCT a.name AS src, b.name AS dst, a.deptype FROM named a JOIN named b ON a.src = b.src AND a.dst = b.dst AND a.deptype = b.deptype AND a.side = 0 AND b.side = 1 WHERE a.name <> b.name""")
def depends_remap(spark, sf_dir) -> DataFrame:
    return depends.remapped(edges(spark, sf_dir))


@query("""WITH RECURSIVE every AS (SELECT c_custkey AS a, c_custkey // 2 AS b FROM customer UNION SELECT c_custkey, c_custkey // 3 + 1 FROM customer WHERE c_custkey > 3 UNION SELECT c_custkey, c_custkey FROM customer),
fk AS (SELECT * FROM every WHERE a <> b),
walk AS (SELECT b AS relid, 0 AS depth FROM fk WHERE b NOT IN (SELECT a FROM fk) UNION SELECT fk.a, walk.depth + 1 FROM walk JOIN fk ON fk.b = walk.relid)
SELECT relid, CAST(max(depth) AS INT) AS depth FROM walk GROUP BY relid""")
def fk_topological_depth(spark, sf_dir) -> DataFrame:
    """Each customer refers to those of half and of a third of its key, and to itself."""
    k = F.col("c_custkey")
    half, third = F.floor(k / 2).cast("long"), F.when(k > 3, F.floor(k / 3).cast("long") + 1)
    x = table(spark, sf_dir, "customer").select(k.cast("long").alias("conrelid"), F.explode(F.array(half, third, k.cast("long"))).alias("confrelid"))
    return depends.foreign_key_depth(x.where("confrelid IS NOT NULL"))


@query(f"""WITH RECURSIVE {EDGES_SQL}, r AS (SELECT 'n3' AS obj UNION SELECT 'n7' UNION SELECT e.dst FROM r JOIN edges e ON e.src = r.obj) SELECT obj FROM r""")
def depends_of_filtered(spark, sf_dir) -> DataFrame:
    return depends.dependents_of(edges(spark, sf_dir), spark.createDataFrame([("n3",), ("n7",)], "obj string"))


@query("""
WITH g AS (SELECT n_regionkey, min(n_name) AS anchor FROM nation GROUP BY n_regionkey)
SELECT n_name AS tname, CAST((SELECT count(*) FROM nation m WHERE m.n_regionkey = n.n_regionkey AND m.n_name <= n.n_name) AS INT) AS rn, anchor,
  format('select create_distributed_table({0}{1}{0}, {0}id{0}, {2})', chr(39), n_name, CASE WHEN n_name = anchor THEN format('shard_count := 32, colocate_with := {0}none{0}', chr(39)) ELSE format('colocate_with := {0}{1}{0}', chr(39), anchor) END) AS command
FROM nation n JOIN g ON g.n_regionkey = n.n_regionkey""")
def anchor_first_value(spark, sf_dir) -> DataFrame:
    t = table(spark, sf_dir, "nation").select(F.col("n_name").alias("tname"), F.lit("id").alias("distribution_column"), F.col("n_regionkey").alias("colocation_id"), F.lit(32).alias("shard_count"))
    return catalog.numbered(catalog.co_located(t), ["colocation_id"], "tname").select("tname", "rn", "anchor", "command")


@query("SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderpriority FROM orders ORDER BY o_custkey, o_orderpriority, o_orderkey")
def distinct_on_first(spark, sf_dir) -> DataFrame:
    return catalog.first_by(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey").select("o_custkey", "o_orderkey", "o_orderpriority")


@query("""SELECT c_custkey, o.o_orderkey, CAST(round(o.o_totalprice * 100) AS BIGINT) AS cents FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS k FROM orders) o ON o.o_custkey = c_custkey AND o.k = 1""")
def lateral_top1(spark, sf_dir) -> DataFrame:
    """The last order of each customer, by an aggregate instead of a sort."""
    o = table(spark, sf_dir, "orders")
    best = o.groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", "o_totalprice"), F.struct("o_orderdate", -F.col("o_orderkey"))).alias("b"))
    return table(spark, sf_dir, "customer").join(best, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.col("b.o_orderkey").alias("o_orderkey"), F.round(F.col("b.o_totalprice") * 100).cast("long").alias("cents"))


#: Suppliers are indexes of the tables of their nations: some primary, some unique, of one or two columns.
INDEXES_SQL = """i AS (SELECT s_nationkey AS tableoid, s_name AS indexname, s_suppkey % 5 = 0 AS isprimary, s_suppkey % 3 <> 1 AS isunique, CASE WHEN s_suppkey % 4 = 0 THEN 'a,b' ELSE 'c' || CAST(s_suppkey % 7 AS VARCHAR) END AS cols,
  CASE WHEN s_suppkey % 4 = 0 THEN 'int,int' WHEN s_suppkey % 2 = 0 THEN 'bigint' ELSE 'string' END AS types FROM supplier)"""


@query(f"""WITH {INDEXES_SQL}
SELECT tableoid, cols AS attname FROM (SELECT *, row_number() OVER (PARTITION BY tableoid ORDER BY NOT isprimary, indexname) AS k FROM i WHERE isunique AND cols NOT LIKE '%,%' AND types IN ('int', 'bigint')) WHERE k = 1""")
def key_candidate_topk(spark, sf_dir) -> DataFrame:
    k = F.col("s_suppkey")
    cols = F.when(k % 4 == 0, "a,b").otherwise(F.concat(F.lit("c"), (k % 7).cast("string")))
    types = F.when(k % 4 == 0, "int,int").when(k % 2 == 0, "bigint").otherwise("string")
    i = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("tableoid"), F.col("s_name").alias("indexname"), (k % 5 == 0).alias("isprimary"), (k % 3 != 1).alias("isunique"), F.split(cols, ",").alias("columns"), F.split(types, ",").alias("types"))
    return catalog.split_key(i)


@query("SELECT table_name AS relname, string_agg(column_name, ', ' ORDER BY ordinal_position) FILTER (WHERE data_type NOT LIKE 'TIMESTAMP%') AS attrs FROM information_schema.columns WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem') GROUP BY table_name")
def table_attributes(spark, sf_dir) -> DataFrame:
    """By the tables' own schemas; times stand for generated columns."""
    attrs = catalog.of_frames(spark, {t: table(spark, sf_dir, t) for t in STAR})["s_attr"]
    return catalog.attribute_lists(attrs.select(F.col("relname").alias("oid"), "attnum", "attname", F.col("typname").startswith("timestamp").alias("attisgenerated"))).withColumnRenamed("oid", "relname")


@query("SELECT c_custkey AS oid FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey HAVING sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) = 0 AND count(o_orderkey) > 0")
def having_no_key(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("oid"))
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("oid"), (F.col("o_orderstatus") == "F").alias("attisprimary"))
    return catalog.tables_without_key(c, a)


@query("SELECT o_custkey AS oid FROM orders GROUP BY o_custkey HAVING sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) > 0 AND o_custkey IN (SELECT c_custkey FROM customer)")
def having_conditional(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("oid"))
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("oid"), (F.col("o_orderpriority") == "1-URGENT").alias("attisgenerated"))
    return catalog.tables_with_generated(c, a)


@query("""
SELECT (SELECT count(*) FROM customer) AS tables, (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS attrs, (SELECT count(*) FROM nation JOIN customer ON n_nationkey = c_custkey) AS indexes,
  CAST((SELECT sum(c_nationkey) FROM customer) AS BIGINT) AS bytes, CAST((SELECT sum(c_custkey) FROM customer) AS BIGINT) AS tuples""")
def catalog_stats(spark, sf_dir) -> DataFrame:
    t = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("oid"), F.col("c_nationkey").cast("long").alias("bytes"), F.col("c_custkey").alias("reltuples"))
    return catalog.table_stats(t, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("oid")), table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("tableoid")))


@query("SELECT " + ", ".join(f"(SELECT count(*) FROM {t}) AS {t}" for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")))
def object_counts(spark, sf_dir) -> DataFrame:
    return catalog.object_counts({t: table(spark, sf_dir, t) for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")})


@query("SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) FILTER (WHERE n_nationkey % 2 = 0) AS even_names, string_agg(n_name, ',' ORDER BY n_nationkey DESC) AS names FROM nation GROUP BY n_regionkey")
def group_concat_filter(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.expr("string_agg(n_name, ',') WITHIN GROUP (ORDER BY n_name) FILTER (WHERE n_nationkey % 2 = 0)").alias("even_names"), F.expr("string_agg(n_name, ',') WITHIN GROUP (ORDER BY n_nationkey DESC)").alias("names"))


@query("""
WITH v AS (SELECT DISTINCT n_regionkey AS k, 2 + n_nationkey % 2 AS steps, '1.' || CAST(n_nationkey AS VARCHAR) AS version FROM nation)
SELECT 'ext' || CAST(k AS VARCHAR) AS extname, '["' || string_agg(version, '","' ORDER BY steps, version) || '"]' AS versions FROM v GROUP BY k""")
def extension_versions(spark, sf_dir) -> DataFrame:
    """Nations are versions of their region's extension, some by a version in between."""
    k = F.col("n_nationkey")
    path = F.concat(F.lit("1.0--"), F.when(k % 2 == 1, "1.0.1--").otherwise(""), F.lit("1."), k.cast("string"))
    return catalog.extension_versions(table(spark, sf_dir, "nation").select(F.concat(F.lit("ext"), F.col("n_regionkey").cast("string")).alias("extname"), path.alias("path")))


def timings(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("section"), F.lit(1).cast("long").alias("count"), F.round("value").cast("long").alias("bytes"), F.col("user_id").alias("duration_ms"), (F.col("event_id") % 3).alias("datname"))


@query("SELECT event_type AS section, count(*) AS count, CAST(sum(CAST(round(value) AS BIGINT)) AS BIGINT) AS bytes, CAST(sum(user_id) AS BIGINT) AS duration_ms FROM events GROUP BY event_type")
def upsert_accumulate_timings(spark, sf_dir) -> DataFrame:
    return progress.all_databases(timings(spark, sf_dir))


@query("SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def first_finisher_election(spark, sf_dir) -> DataFrame:
    return progress.elected(table(spark, sf_dir, "events"), ["user_id"], "event_id", ["ts", "event_id"])


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1")
def upsert_latest_row(spark, sf_dir) -> DataFrame:
    return progress.latest(table(spark, sf_dir, "events"), ["user_id"], F.desc("event_id")).select("user_id", "event_id", "event_type")


#: Orders are tables, line items their parts: done if returned.
PARTS_SQL = "parts AS (SELECT l_orderkey AS tableoid, count(*) OVER (PARTITION BY l_orderkey) AS partcount, CAST(round(l_extendedprice) AS BIGINT) AS bytes, CASE WHEN l_linestatus = 'F' OR l_returnflag = 'A' THEN l_shipdate END AS done_time, CASE WHEN l_quantity > 10 THEN l_shipdate END AS start_time FROM lineitem)"


def parts(spark, sf_dir) -> DataFrame:
    x = table(spark, sf_dir, "lineitem")
    n = x.groupBy("l_orderkey").agg(F.count("*").alias("partcount"))
    return x.join(n, "l_orderkey").select(F.col("l_orderkey").alias("tableoid"), "partcount", F.round("l_extendedprice").cast("long").alias("bytes"), F.when((F.col("l_linestatus") == "F") | (F.col("l_returnflag") == "A"), F.col("l_shipdate")).alias("done_time"), F.when(F.col("l_quantity") > 10, F.col("l_shipdate")).alias("start_time"))


@query(f"""WITH {PARTS_SQL}, d AS (SELECT tableoid, partcount, count(done_time) = partcount AS all_done FROM parts GROUP BY tableoid, partcount)
SELECT (SELECT count(*) FROM orders) AS tables, (SELECT count(*) FROM d WHERE all_done) AS tables_done, (SELECT count(*) FROM supplier) AS indexes, (SELECT count(*) FROM supplier WHERE s_acctbal > 0) AS indexes_done""")
def done_counts(spark, sf_dir) -> DataFrame:
    i = table(spark, sf_dir, "supplier").select(F.when(F.col("s_acctbal") > 0, F.lit(1)).alias("done_time"))
    return progress.done_counts(table(spark, sf_dir, "orders"), parts(spark, sf_dir), i)


@query(f"WITH {PARTS_SQL} SELECT CAST(sum(bytes) AS BIGINT) AS total, CAST(sum(bytes) FILTER (WHERE done_time IS NOT NULL) AS BIGINT) AS done, CAST(sum(bytes) FILTER (WHERE start_time IS NOT NULL AND done_time IS NULL) AS BIGINT) AS in_progress FROM parts")
def byte_totals(spark, sf_dir) -> DataFrame:
    return progress.byte_totals(parts(spark, sf_dir))


@query(f"WITH {PARTS_SQL} SELECT tableoid, partcount, count(done_time) AS done, count(done_time) = partcount AS all_done FROM parts GROUP BY tableoid, partcount")
def parts_all_done(spark, sf_dir) -> DataFrame:
    return progress.parts_done(parts(spark, sf_dir))


@query("""
WITH s AS (SELECT o_orderkey AS tableoid, o_custkey AS pid, 1 AS partnum, o_orderdate AS start_time FROM orders WHERE o_orderstatus <> 'F')
SELECT s.pid, s.tableoid, s.partnum, p.n AS partcount FROM s JOIN customer ON c_custkey = s.pid AND c_acctbal > 0 LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) p ON p.l_orderkey = s.tableoid""")
def progress_in_copy_join(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    summary = o.select(F.col("o_orderkey").alias("tableoid"), F.col("o_custkey").alias("pid"), F.lit(1).alias("partnum"), F.col("o_orderdate").alias("start_time"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("done_time"))
    c = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    process = summary.select("pid", "tableoid", "partnum").join(c, F.col("pid") == F.col("c_custkey"), "left_semi")
    p = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("tableoid")).agg(F.count("*").alias("partcount")).select("tableoid", F.lit(1).alias("partnum"), "partcount", F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"))
    return progress.in_progress(process, o.select(F.col("o_orderkey").alias("oid")), summary, p).select("pid", "tableoid", "partnum", "partcount")


@query("""SELECT s_suppkey AS oid, 'db' || CAST(s_nationkey % 3 AS VARCHAR) AS datname, CAST(k AS INT) AS position, CAST((k - 1) % 4 AS INT) AS worker FROM (SELECT *, row_number() OVER (ORDER BY CAST(round(s_acctbal) AS BIGINT) DESC, 'db' || CAST(s_nationkey % 3 AS VARCHAR), s_suppkey) AS k FROM supplier)""")
def largest_first_schedule(spark, sf_dir) -> DataFrame:
    t = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("oid"), F.concat(F.lit("db"), (F.col("s_nationkey") % 3).cast("string")).alias("datname"), F.round("s_acctbal").cast("long").alias("bytes"))
    return progress.schedule(t, 4).select("oid", "datname", "position", "worker")


@query("""WITH i AS (SELECT s_suppkey AS indexoid, s_nationkey AS tableoid FROM supplier), d AS (SELECT s_suppkey AS indexoid FROM supplier WHERE s_acctbal > 0)
SELECT tableoid, count(*) AS n FROM i WHERE indexoid NOT IN (SELECT indexoid FROM d) GROUP BY tableoid""")
def indexes_not_built(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return progress.not_built(s.select(F.col("s_suppkey").alias("indexoid"), F.col("s_nationkey").alias("tableoid")), s.where("s_acctbal > 0").select(F.col("s_suppkey").alias("indexoid")))


@query("""
SELECT o_orderkey AS oid, CAST(round(o_totalprice) AS BIGINT) AS bytes, p.n AS partcount, CAST(s.d AS BIGINT) AS duration_ms, CAST(s.b AS BIGINT) AS bytes_sent, c.checksum
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) p ON p.l_orderkey = o_orderkey
LEFT JOIN (SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS d, sum(CAST(round(l_extendedprice) AS BIGINT)) AS b FROM lineitem GROUP BY 1) s ON s.l_orderkey = o_orderkey
LEFT JOIN (SELECT c_custkey, c_name AS checksum FROM customer) c ON c.c_custkey = o_orderkey""")
def table_report(spark, sf_dir) -> DataFrame:
    """Parts and summaries of each table, neither of which multiplies the other."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tableoid"), F.col("l_quantity").cast("long").alias("duration_ms"), F.round("l_extendedprice").cast("long").alias("bytes"))
    t = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("oid"), F.round("o_totalprice").cast("long").alias("bytes"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("oid"), F.col("c_name").alias("checksum"))
    return progress.table_report(t, li, li, c).select("oid", "bytes", "partcount", "duration_ms", "bytes_sent", "checksum")


@query("SELECT c_custkey AS k, CAST(m AS INT) AS mask, CAST((m & 1) * 4 + ((m >> 1) & 1) * 3 + ((m >> 2) & 1) * 2 + ((m >> 3) & 1) * 5 AS INT) AS concurrency FROM (SELECT c_custkey, c_custkey % 16 AS m FROM customer)")
def job_mask_concurrency(spark, sf_dir) -> DataFrame:
    m = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 16).cast("int").alias("mask"))
    return m.select("k", "mask", progress.concurrency(F.col("mask"), {"copy": 4, "index": 3, "vacuum": 2, "large_objects": 5}).cast("int").alias("concurrency"))


@query("""SELECT i.s_suppkey AS oid, CASE WHEN s_nationkey % 3 = 0 THEN 'ALTER TABLE t ADD CONSTRAINT ' || s_name || ' PRIMARY KEY USING INDEX ' || s_name || CASE WHEN s_acctbal > 0 THEN ' DEFERRABLE' ELSE '' END
  WHEN s_nationkey % 3 = 1 THEN 'ALTER TABLE t ADD CONSTRAINT ' || s_name || ' UNIQUE USING INDEX ' || s_name || CASE WHEN s_acctbal > 0 THEN ' DEFERRABLE' ELSE '' END ELSE 'ALTER TABLE t ADD CONSTRAINT ' || s_name || ' CHECK (x > 0)' END AS command FROM supplier i""")
def constraint_commands(spark, sf_dir) -> DataFrame:
    s, k = table(spark, sf_dir, "supplier"), F.col("s_nationkey") % 3
    kind = F.when(k == 0, "p").when(k == 1, "u").otherwise("c")
    command = catalog.constraint_command(F.lit("t"), F.col("s_name"), kind, F.lit("CHECK (x > 0)"), F.col("s_name"), F.col("s_acctbal") > 0, F.lit(False))
    return s.select(F.col("s_suppkey").alias("oid"), command.alias("command"))


@query("""WITH t AS (SELECT n_nationkey AS oid, n_name AS name FROM nation), f AS (SELECT n_nationkey AS oid FROM nation WHERE n_regionkey = 1)
SELECT oid, name FROM t WHERE oid NOT IN (SELECT oid FROM f)""")
def extension_anti_join(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    depend = n.select(F.col("n_nationkey").alias("objid"), F.when(F.col("n_regionkey") == 1, "e").otherwise("n").alias("deptype"))
    return filters.without_extension_members(n.select(F.col("n_nationkey").alias("oid"), F.col("n_name").alias("name")), depend)


@query("""SELECT oid, name, used_by FROM (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY name, used_by) AS k FROM (
  SELECT n_regionkey AS oid, n_name AS name, 'database' AS used_by FROM nation WHERE n_nationkey % 2 = 0 UNION SELECT n_regionkey, n_name, 'column' FROM nation WHERE n_nationkey % 3 = 0 UNION SELECT n_regionkey, n_name, 'index' FROM nation)) WHERE k = 1""")
def collations_distinct_on(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    of = lambda w, u: n.where(w).select(F.col("n_regionkey").alias("oid"), F.col("n_name").alias("name"), F.lit(u).alias("used_by"))
    return catalog.collations_in_use([of("n_nationkey % 2 = 0", "database"), of("n_nationkey % 3 = 0", "column"), of("true", "index")])


@query("SELECT n_regionkey AS oid, bool_and(n_nationkey > 1) AS safe FROM nation GROUP BY 1")
def binary_safety(spark, sf_dir) -> DataFrame:
    return catalog.all_binary_safe(table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "oid"), F.col("n_nationkey") > 1)
