import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeshift.operators import compare, copy, depends, filters, progress, split
from lakeshift.sources.rules import COMPLEMENT, RuleError, is_pattern, parse_rules


def ranges(parts):
    return [(p.lo, p.hi) for p in parts]


def test_key_splits():
    parts = split.key_parts(102400, 10240, 1, 100)
    assert len(parts) == 11 and parts[0].is_null_part and ranges(parts)[1:3] == [(1, 10), (11, 20)] and ranges(parts)[-1] == (91, None)
    assert ranges(split.key_parts(51200, 10240, 1, 100))[1:] == [(1, 17), (18, 34), (35, 51), (52, 68), (69, None)]
    assert ranges(split.key_parts(102400, 10240, 1, 100, 3))[1:] == [(1, 34), (35, None)]


def test_page_splits():
    assert ranges(split.page_parts(16, 10240)) == [(0, 1), (2, 3), (4, 5), (6, 7), (8, 9), (10, 11), (12, 13), (14, None)]
    assert not any(p.is_null_part for p in split.page_parts(16, 10240))


@given(st.integers(1, 10**9), st.integers(1, 10**8), st.integers(-1000, 1000), st.integers(0, 5000), st.integers(0, 7))
@settings(max_examples=200, deadline=None)
def test_parts_hold_each_key_once(total, part, least, width, most):
    part = max(part, total // 500 + 1)
    parts = split.key_parts(total, part, least, least + width, most)
    inside = lambda p, k: p.partcount == 1 or (not p.is_null_part and k >= p.lo and (p.hi is None or k <= p.hi))
    for k in {least, least + width, least + width // 2, -1 if least <= -1 <= least + width else least, least + width + 1}:
        assert sum(inside(p, k) for p in parts) == 1


def test_scans_of_parts_are_the_table(spark):
    df = spark.range(-20, 200).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    parts = split.key_parts(1000, 90, *split.key_bounds(df, "k"))
    x = split.scan_all(df, parts, "k")
    assert sorted(r.v for r in x.collect()) == list(range(-20, 200))
    assert x.where(split.part_of(F.col("k"), parts) != F.col("partnum")).count() == 0
    assert split.predicate_sql(parts[0], "k") == "WHERE k IS NULL" and split.predicate_sql(parts[-1], "k").startswith("WHERE k >= ")


def test_split_of_small_and_empty_tables(spark):
    assert split.key_parts(10, 100, 5, 5, 1) == [split.Part(1, 1)]
    empty = spark.range(0).withColumnRenamed("id", "k")
    assert split.plan_key_split(empty, "t", "k", 0, 10).count() == 1
    assert [split.split_method(5, 10, "k"), split.split_method(50, 10, "k"), split.split_method(50, 10, None), split.split_method(50, 10, None, standby=True)] == ["none", "key", "pages", "none"]


def test_rules_file():
    r = parse_rules('[include-only-schema]\npublic\n~/^seq$/\n[include-only-table]\npublic.actor\nfoo.~/^tbl/~[_x$]\n~<a.b>."q""x"\n; comment\n[exclude-index]\npublic.idx\n')
    assert r.kind == "include" and [x.match_class for x in r.of("include-only-table")] == ["EE", "ER", "RE"]
    assert r.of("include-only-table")[1].relname_re == "^tbl_x$" and r.of("include-only-table")[2].relname == 'q"x'
    assert COMPLEMENT[COMPLEMENT["include"]] == "include"
    assert is_pattern("a.~/x/") and not is_pattern('"a~b".c')


@pytest.mark.parametrize("text", ["[exclude-table]\nnoschema\n", "[exclude-table]\na.~/x\n", "[exclude-table]\na.~!x!\n", "[what]\na\n", "[include-only-table]\na.b\n[exclude-table]\nc.d\n", "[exclude-table]\na.~/[x/\n", "[include-only-schema]\na\n[exclude-schema]\nb\n"])
def test_bad_rules(text):
    with pytest.raises((RuleError, Exception)):
        _ = parse_rules(text).kind


@pytest.mark.parametrize("quote", ["/ /", "[ ]", "{ }", "( )", "< >", '" "', "' '", "| |", "# #", "$ $"])
def test_delimiters(quote):
    a, b = quote.split(" ")
    assert parse_rules(f"[exclude-schema]\n~{a}^x{b}\n").rules[0].nspname_re == "^x"


def test_selection_and_complement_part_the_objects(spark):
    t = spark.createDataFrame([("public", "a", 1), ("public", "tbl_1", 2), ("foo", "tbl_2", 3), ("foo", "x", 4), ("bar", "y", 5)], "nspname string, relname string, oid int")
    for rules in ("[include-only-table]\npublic.a\nfoo.~/^tbl/\n", "[exclude-schema]\nbar\n[exclude-table]\nfoo.~/^tbl/\n", "[exclude-table-data]\nfoo.x\n", ""):
        r = parse_rules(rules)
        kept, rest = filters.select_tables(t, r), filters.select_tables(t, r, complement=True)
        assert kept.count() + rest.count() == 5 and kept.join(rest, "oid").count() == 0
    assert filters.select_tables(t, parse_rules("[exclude-table-data]\nfoo.x\n")).where("exclude_data").count() == 1
    rules = parse_rules("[include-only-table]\npublic.a\nfoo.~/^tbl/\n")
    assert filters.rule_matches(t, rules.frame(spark), "include-only-table").count() == 2 and filters.rule_matches(t, rules.frame(spark), "include-only-table", anti=True).count() == 3


def test_missing_tables_to_include_are_errors(spark):
    t = spark.createDataFrame([("public", "a", 1)], "nspname string, relname string, oid int")
    with pytest.raises(RuleError):
        filters.resolve(parse_rules("[include-only-table]\npublic.b\n"), t)
    assert filters.resolve(parse_rules("[exclude-table]\npublic.b\n"), t).first().oid is None


def test_closures_end_in_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    a, b = depends.closure(e), depends.closure(e, e.selectExpr("src AS obj"), near=0)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert {r.obj for r in a.where("root = 'a'").collect()} == {"a", "b", "c", "d"}
    assert {r.obj for r in depends.dependents_of(e, spark.createDataFrame([("d",)], "obj string")).collect()} == {"d"}


def test_deep_and_layered_dependencies(spark):
    """Many paths between few objects, and a long chain: neither is listed path by path or step by step."""
    layers = [(f"{k}.{a}", f"{k + 1}.{b}") for k in range(12) for a in range(3) for b in range(3)]
    e = spark.createDataFrame(layers, "src string, dst string")
    got = depends.closure(e, spark.createDataFrame([("0.0",)], "obj string"))
    assert {(r.obj, r.depth) for r in got.collect()} == {("0.0", 0), *((f"{k}.{b}", k) for k in range(1, 13) for b in range(3))}
    chain = spark.createDataFrame([(k, k + 1) for k in range(130)], "src int, dst int")
    assert depends.closure(chain, near=2).count() == sum(131 - k for k in range(130))
    reached = depends.closure(chain, spark.createDataFrame([(0,)], "obj int"), near=2)
    assert sorted((r.obj, r.depth) for r in reached.collect()) == [(k, k) for k in range(131)]
    inside = chain.withColumn("deptype", F.lit("i")).unionByName(spark.createDataFrame([(130, 999, "n"), (500, 77, "a")], "src int, dst int, deptype string"))
    assert {tuple(r) for r in depends.remapped(inside).collect()} == {(0, 999, "n"), (500, 0, "a")}


def test_depth_of_long_chains_and_cycles(spark):
    keys = [(k + 1, k) for k in range(10_000)] + [(20_001, 20_000), (20_000, 20_001), (20_001, 5), (30_000, 30_001), (30_001, 30_000), (7, 7)]
    layers = [(100_000 + 10 * (k + 1) + a, 100_000 + 10 * k + b) for k in range(12) for a in range(3) for b in range(3)]
    got = {r.relid: r.depth for r in depends.foreign_key_depth(spark.createDataFrame(keys + layers, "conrelid int, confrelid int")).collect()}
    assert got[10_000] == 10_000 and got[20_001] == 6 and got[20_000] == 7 and 30_000 not in got and got[100_120] == 12


def test_checksums_tell_rows_apart(spark):
    from lakeshift.functions.checksum import table_checksum

    rows = [[(1.001, "a|b", "c")], [(1.004, "a|b", "c")], [(1.001, "a", "b|c")], [(1e300, None, "c")], [(1e300, "c", None)], [(1e300, "~N", "c")], [(float("nan"), "N", "c")], [(float("inf"), "", "")], [(float("-inf"), "", "")], [(5e-324, "", "")], [(1e-323, "", "")], [(0.1 + 0.2, "", "")], [(0.3, "", "")], [(None, "", "")], [(2.0, "", "")], [(1.9999999999999998, "", "")], [(4.0, "", "")]]
    for portable in (True, False):
        sums = [table_checksum(spark.createDataFrame(r, "x double, a string, b string"), portable=portable).first().checksum for r in rows]
        assert len(set(sums)) == len(rows)
        zero, minus = (table_checksum(spark.createDataFrame([(x,)], "x double"), portable=portable).first().checksum for x in (0.0, -0.0))
        assert zero == minus


def test_compare(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    got = compare.compare_data({"same": a, "rows": a, "sum": a, "gone": a, "wide": a}, {"same": a.orderBy("v"), "rows": a.limit(1), "sum": a.fillna("y"), "wide": a.withColumn("more", F.lit(1))}, portable=False)
    assert {r.table_name: r.status for r in got.collect()} == {"same": "ok", "rows": "rows", "sum": "checksum", "gone": "missing", "wide": "ok"}
    assert compare.compare_many({"d1": ({"t": a}, {"t": a}), "d2": ({"t": a}, {"t": a.limit(0)})}).where("status <> 'ok'").first().datname == "d2"
    s, t = (spark.createDataFrame(r, "nspname string, relname string, x int") for r in ([("p", "a", 1), ("p", "b", None)], [("p", "a", 2), ("p", "b", None), ("p", "c", 3)]))
    assert [tuple(r) for r in compare.compare_objects(s, t, ["nspname", "relname"], ["x"], "k").collect()] == [("k", "p.a", "x")]
    assert compare.compare_objects(s, t, ["nspname", "relname"], ["x"], "k", both=True).where("difference = 'extra'").count() == 1


def test_copy_resumes_and_verifies(spark, tmp_path):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    parts = split.key_parts(1000, 300, 0, 99)
    target = copy.Target(spark, str(tmp_path / "t"))
    notes = copy.copy_tables({"t": (df, parts, "id"), "u": (df.limit(3), [split.Part(1, 1)], None)}, target)
    assert notes.where("table_name = 't'").agg(F.sum("rows")).first()[0] == 100
    assert {r.status for r in copy.verified({"t": df}, target).collect()} == {"ok"}
    before = target.done().agg(F.max("done_time")).first()[0]
    again = copy.copy_tables({"t": (df, parts, "id")}, copy.Target(spark, str(tmp_path / "t")), resume=True)
    assert again.count() == len(parts) + 1 and again.agg(F.max("done_time")).first()[0] == before
    assert progress.parts_done(notes.select(F.col("table_name").alias("tableoid"), "partcount", "done_time")).where("all_done").count() == 2
    copy.copied_at_once(df, str(tmp_path / "once"), parts, "id")
    assert spark.read.parquet(str(tmp_path / "once")).count() == 100


def test_retries_are_for_transient_errors():
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise OSError

    assert copy.with_retries(flaky, wait=0) == 3
    with pytest.raises(ValueError):
        copy.with_retries(lambda: (_ for _ in ()).throw(ValueError()), wait=0)


def test_reports_do_not_multiply(spark):
    t = spark.createDataFrame([(1, 10), (2, 20)], "oid long, bytes long")
    p = spark.createDataFrame([(1,), (1,), (1,)], "tableoid long")
    s = spark.createDataFrame([(1, 5, 7), (1, 5, 7)], "tableoid long, duration_ms long, bytes long")
    c = spark.createDataFrame([(1, "x")], "oid long, checksum string")
    r = {x.oid: x for x in progress.table_report(t, p, s, c).collect()}
    assert (r[1].partcount, r[1].duration_ms, r[1].bytes_sent) == (3, 10, 14) and r[2].partcount is None


def test_sequences(spark):
    s = spark.createDataFrame([("a", 5, False), ("b", 9, True), ("c", 1, False)], "relname string, last_value long, is_called boolean")
    got = {r.relname: (r.last_value, r.is_called) for r in copy.sequences_reset(s, {"a": 7, "b": 3}).collect()}
    assert got == {"a": (7, True), "b": (9, True), "c": (1, False)}


def test_store_goes_on_where_it_was_left(spark, tmp_path):
    from lakeshift.operators.store import Store

    rows = spark.createDataFrame([(k, "a", k * 10) for k in range(6)], "oid int, name string, bytes int")
    Store(spark, str(tmp_path)).add("s_table", rows)
    s = Store(spark, str(tmp_path))  # another run
    s.change("s_table", spark.createDataFrame([(1, 7)], "oid int, bytes int"))
    s.remove("s_table", spark.createDataFrame([(2,)], "oid int"))
    s.add_new("s_table", spark.createDataFrame([(2, "b", 1), (3, "b", 1)], "oid int, name string, bytes int"))
    got = {r.oid: (r.name, r.bytes) for r in s.state("s_table").collect()}
    assert got == {0: ("a", 0), 1: ("a", 7), 2: ("b", 1), 3: ("a", 30), 4: ("a", 40), 5: ("a", 50)}
    (tmp_path / "s_table" / "batch=4").mkdir()  # a batch that was broken off
    assert s.state("s_table").count() == 6
    s.remove("s_table")
    assert s.state("s_table").count() == 0 and s.state("s_index") is None
    s.add("s_table", rows.limit(1))
    assert s.catalog().lookup("s_table", oid=0).count() == 1


def test_clones_go_on(spark, tmp_path):
    from lakeshift.operators.store import clone_databases

    t = spark.range(20).withColumnRenamed("id", "k")
    seqs = {"a": (spark.createDataFrame([("s", 3, False)], "relname string, last_value long, is_called boolean"), {"s": 19})}
    got = clone_databases(spark, {"a": {"t": t}, "b": {"t": t, "u": t.limit(0)}}, str(tmp_path), seqs)
    assert {(r.datname, r.table_name, r.status) for r in got.collect()} == {("a", "t", "ok"), ("b", "t", "ok"), ("b", "u", "ok")}
    assert spark.read.parquet(str(tmp_path / "a" / "_sequences")).first().last_value == 19
    again = clone_databases(spark, {"a": {"t": t}}, str(tmp_path), resume=True)
    assert again.first().status == "ok"
