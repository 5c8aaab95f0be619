"""Parameterised statements for changes, and the dictionary of their templates.

A column is a struct (name, value); names are raw and quoted here. Alike neighbours become one INSERT of several rows
or one DELETE with IN. UPDATEs never merge. Deletes whose identity has a null don't either: they need IS NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions.text import quote_always
from lakeshift.streaming.transactions import with_run

#: Fixed value: how many parameters a statement can have.
MAX_PARAMS = 65535
PAIR = "array<struct<name:string,value:string>>"


def joined(array: Column, of, by: str = ", ") -> Column:
    return F.array_join(F.transform(array, of), by)


def params(first: Column, n: Column) -> Column:
    """$first, ... for n parameters."""
    return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda k: F.concat(F.lit("$"), (first + k - 1).cast("string"))), ", ")


def table_name(nspname: Column, relname: Column) -> Column:
    return F.concat(quote_always(nspname), F.lit("."), quote_always(relname))


def insert_sql(table: Column, names: Column, rows: Column) -> Column:
    """An INSERT of a number of rows."""
    k = F.size(names)
    values = F.array_join(F.transform(F.sequence(F.lit(0), rows - 1), lambda r: F.concat(F.lit("("), params(r * k + 1, k), F.lit(")"))), ", ")
    return F.concat(F.lit("INSERT INTO "), table, F.lit(" ("), joined(names, quote_always), F.lit(") overriding system value VALUES "), values)


def pruned(new: Column, old: Column) -> Column:
    """The new columns that say something: not equal (nulls are) to the old tuple's column of the same name."""
    same = lambda c: F.exists(old, lambda o: (o["name"] == c["name"]) & o["value"].eqNullSafe(c["value"]))
    return F.filter(new, lambda c: ~same(c))


def where_sql(identity: Column, before: Column) -> Column:
    """a = $n and b IS NULL ..., after ``before`` parameters."""
    number = lambda i: before + F.size(F.filter(F.slice(identity, 1, i + 1), lambda x: x["value"].isNotNull()))
    term = lambda c, i: F.concat(quote_always(c["name"]), F.when(c["value"].isNull(), " IS NULL").otherwise(F.concat(F.lit(" = $"), number(i).cast("string"))))
    return F.array_join(F.transform(identity, term), " and ")


def update_sql(table: Column, set_: Column, identity: Column, generated: Column | None = None) -> Column:
    """An UPDATE; null if nothing is set. Generated columns are set to DEFAULT and have no parameter."""
    is_generated = (lambda c: F.array_contains(generated, c["name"])) if generated is not None else (lambda c: F.lit(False))
    number = lambda i: F.size(F.filter(F.slice(set_, 1, i + 1), lambda x: ~is_generated(x)))
    term = lambda c, i: F.concat(quote_always(c["name"]), F.when(is_generated(c), " = DEFAULT").otherwise(F.concat(F.lit(" = $"), number(i).cast("string"))))
    n = F.size(F.filter(set_, lambda c: ~is_generated(c)))
    sets = F.array_join(F.transform(set_, term), ", ")
    return F.when(F.size(set_) > 0, F.concat(F.lit("UPDATE "), table, F.lit(" SET "), sets, F.lit(" WHERE "), where_sql(identity, n)))


def delete_sql(table: Column, identity: Column, rows: Column) -> Column:
    """A DELETE of one row, or of several by one column or a tuple of them."""
    k = F.size(identity)
    one = F.concat(F.lit("DELETE FROM "), table, F.lit(" WHERE "), where_sql(identity, F.lit(0)))
    names = joined(identity, lambda c: quote_always(c["name"]))
    flat = F.concat(F.lit("DELETE FROM "), table, F.lit(" WHERE "), names, F.lit(" IN ("), params(F.lit(1), rows), F.lit(")"))
    tuples = F.array_join(F.transform(F.sequence(F.lit(0), rows - 1), lambda r: F.concat(F.lit("("), params(r * k + 1, k), F.lit(")"))), ", ")
    nested = F.concat(F.lit("DELETE FROM "), table, F.lit(" WHERE ("), names, F.lit(") IN ("), tuples, F.lit(")"))
    return F.when(rows == 1, one).when(k == 1, flat).otherwise(nested)


def truncate_sql(table: Column) -> Column:
    return F.concat(F.lit("TRUNCATE ONLY "), table)


def present(columns: Column) -> Column:
    """Values that are parameters: those that aren't null."""
    return F.transform(F.filter(columns, lambda c: c["value"].isNotNull()), lambda c: c["value"])


def values(columns: Column) -> Column:
    return F.transform(columns, lambda c: c["value"])


def statements(changes: DataFrame, generated: DataFrame | None = None, most: int = MAX_PARAMS, keep_noop: bool = False) -> DataFrame:
    """(xid, id, action, nspname, relname, n_rows, sql, args) of changes (id, xid, action, nspname, relname, new, old).

    new, old: PAIR arrays. id: of a run's first row. Updates that set nothing have a null sql, or set all columns as
    they are with keep_noop. generated: (nspname, relname, attnames) of columns that the target computes.
    """
    x = changes
    if generated is not None:
        x = x.join(generated, ["nspname", "relname"], "left").withColumn("gen", F.coalesce("attnames", F.array().cast("array<string>"))).drop("attnames")
    else:
        x = x.withColumn("gen", F.array().cast("array<string>"))
    x = x.withColumn("new", F.when(F.col("action") == "I", F.filter("new", lambda c: ~F.array_contains("gen", c["name"]))).otherwise(F.col("new")))
    x = x.withColumn("names", F.to_json(F.transform(F.when(F.col("action") == "I", F.col("new")).otherwise(F.col("old")), lambda c: c["name"])))
    alone = (F.col("action").isin("U", "T")) | ((F.col("action") == "D") & F.exists("old", lambda c: c["value"].isNull()))
    x = x.withColumn("single", F.when(alone, F.col("id")))
    n = F.when(F.col("action") == "I", F.size("new")).otherwise(F.size("old"))
    x = with_run(x, ["action", "nspname", "relname", "names", "single"], ["id"], most, n)
    g = x.groupBy("xid", "run", "action", "nspname", "relname").agg(F.min("id").alias("id"), F.count("*").cast("int").alias("n"), F.min_by("new", "id").alias("new"), F.min_by("old", "id").alias("old"), F.min_by("gen", "id").alias("gen"), F.array_sort(F.collect_list(F.struct("id", F.when(F.col("action") == "I", F.col("new")).otherwise(F.col("old")).alias("c")))).alias("rows"))
    t = table_name(F.col("nspname"), F.col("relname"))
    set_ = F.col("new") if keep_noop else pruned(F.col("new"), F.col("old"))
    real = F.filter(set_, lambda c: ~F.array_contains("gen", c["name"]))
    set_ = F.when(F.size(real) > 0, set_).otherwise(real)
    flat = F.flatten(F.transform("rows", lambda r: values(r["c"])))
    sql = F.when(F.col("action") == "I", insert_sql(t, F.transform("new", lambda c: c["name"]), F.col("n"))).when(F.col("action") == "U", update_sql(t, set_, F.col("old"), F.col("gen"))).when(F.col("action") == "D", delete_sql(t, F.col("old"), F.col("n"))).otherwise(truncate_sql(t))
    args = F.when(F.col("action") == "I", flat).when(F.col("action") == "U", F.concat(values(real), present(F.col("old")))).when(F.col("action") == "D", F.when(F.col("n") == 1, present(F.col("old"))).otherwise(flat)).otherwise(F.array().cast("array<string>"))
    return g.select("xid", "id", "action", "nspname", "relname", F.col("n").cast("long").alias("n_rows"), sql.alias("sql"), F.when(sql.isNotNull(), args).alias("args"))


def dictionary(rendered: DataFrame) -> DataFrame:
    """(hash, sql): each template once."""
    return rendered.where("sql IS NOT NULL").select(F.xxhash64("sql").alias("hash"), "sql").distinct()


def facts(rendered: DataFrame) -> DataFrame:
    """Statements by the hash of their template, which is 0 where nothing is to be done."""
    return rendered.withColumn("hash", F.when(F.col("sql").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("sql"))).drop("sql")


def replayed(fact: DataFrame, stmt: DataFrame) -> DataFrame:
    """Statements in their order with their templates again; those without one are left out."""
    return fact.where("hash <> 0").join(stmt, "hash", "left").orderBy("id")


def as_script(rendered: DataFrame) -> DataFrame:
    """PREPARE and EXECUTE lines, one row a statement."""
    name = F.lower(F.hex(F.xxhash64("sql")))
    return rendered.where("sql IS NOT NULL").select("xid", "id", F.concat(F.lit("PREPARE "), name, F.lit(" AS "), F.col("sql"), F.lit(";\nEXECUTE "), name, F.to_json("args"), F.lit(";")).alias("script"))


