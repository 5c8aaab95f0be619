"""Selection of objects by rules: included, excluded, their complements, and what follows for other objects.

Rules are few (a file's lines) and become literal predicates, so that no join is needed and Catalyst can push what
is pushable; relations of rules (rule_matches) serve where the rules themselves come from a table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions.text import posix_regex
from lakeshift.sources.rules import Rule, RuleError, Rules


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def matches(rule: Rule, nspname: Column, relname: Column | None = None) -> Column:
    """Whether an object's names match one rule; patterns match anywhere, as they aren't anchored."""
    nsp = nspname.rlike(posix_regex(rule.nspname_re)) if rule.nspname_re is not None else nspname == rule.nspname
    if relname is None or (rule.relname is None and rule.relname_re is None):
        return nsp
    return nsp & (relname.rlike(posix_regex(rule.relname_re)) if rule.relname_re is not None else relname == rule.relname)


def user_objects(nspname: Column, own: str = "lakeshift") -> Column:
    """Not a system schema, nor the engine's own."""
    return ~nspname.rlike("^pg_") & (nspname != "information_schema") & ~nspname.contains(own)


def ordinary(relkind: Column, persistence: Column, partitioned: bool = False) -> Column:
    return relkind.isin(*(["r", "p", "m"] if partitioned else ["r", "m"])) & persistence.isin("p", "u")


def by_oid(oid: Column, oids: list[int] | None) -> Column:
    """Membership in a list; no list is no restriction."""
    return F.lit(True) if oids is None else oid.isin(oids)


def schema_selected(rules: Rules, nspname: Column) -> Column:
    """Schemas that are included (all, without such rules) and not excluded."""
    include = rules.of("include-only-schema")
    kept = any_of([matches(r, nspname) for r in include]) if include else F.lit(True)
    return kept & ~any_of([matches(r, nspname) for r in rules.of("exclude-schema")])


def table_selected(rules: Rules, nspname: Column, relname: Column) -> Column:
    include = rules.of("include-only-table")
    kept = any_of([matches(r, nspname, relname) for r in include]) if include else F.lit(True)
    return schema_selected(rules, nspname) & kept & ~any_of([matches(r, nspname, relname) for r in rules.of("exclude-table")])


def table_skipped(rules: Rules, nspname: Column, relname: Column) -> Column:
    """The complement: not included, or in a schema that isn't selected, or excluded."""
    return ~table_selected(rules, nspname, relname)


def data_excluded(rules: Rules, nspname: Column, relname: Column) -> Column:
    return any_of([matches(r, nspname, relname) for r in rules.of("exclude-table-data")])


def index_selected(rules: Rules, nspname: Column, indexname: Column) -> Column:
    return ~any_of([matches(r, nspname, indexname) for r in rules.of("exclude-index")])


def extension_selected(rules: Rules, extname: Column) -> Column:
    include = rules.of("include-only-extension")
    kept = any_of([matches(r, extname) for r in include]) if include else F.lit(True)
    return kept & ~any_of([matches(r, extname) for r in rules.of("exclude-extension")])


def select_tables(tables: DataFrame, rules: Rules, nsp: str = "nspname", rel: str = "relname", complement: bool = False) -> DataFrame:
    """The selected tables with the flag exclude_data, or those that the rules leave out."""
    keep = table_selected(rules, F.col(nsp), F.col(rel))
    return tables.where(~keep if complement else keep).withColumn("exclude_data", data_excluded(rules, F.col(nsp), F.col(rel)))


def without_extension_members(objects: DataFrame, depend: DataFrame, oid: str = "oid") -> DataFrame:
    """Objects that no extension owns (depend: objid, deptype)."""
    return objects.join(depend.where("deptype = 'e'").select(F.col("objid").alias(oid)).distinct(), oid, "left_anti")


def rule_matches(objects: DataFrame, rules: DataFrame, section: str, anti: bool = False) -> DataFrame:
    """Objects (nspname, relname) that match any, or no, rule of a section of a rule table, whatever its size.

    Exact names are an equi-join. Patterns have no key to join by: a nested loop over the patterns, of which a rule
    file has a few; Spark decides on broadcasting by their measured size.
    """
    r = rules.where(F.col("section") == section)
    exact = r.where("nspname IS NOT NULL AND relname IS NOT NULL").select("nspname", "relname").distinct()
    exact_in = objects.join(exact, ["nspname", "relname"], "left_semi")
    by_re = r.where("nspname_re IS NOT NULL OR relname_re IS NOT NULL").select("nspname", "relname", "nspname_re", "relname_re")
    o, p = objects.alias("o"), by_re.alias("p")
    on = (F.coalesce(F.col("o.nspname") == F.col("p.nspname"), F.lit(True)) & F.coalesce(F.expr("o.nspname RLIKE p.nspname_re"), F.lit(True)) & F.coalesce(F.col("o.relname") == F.col("p.relname"), F.lit(True)) & F.coalesce(F.expr("o.relname RLIKE p.relname_re"), F.lit(True)))
    if anti:
        return objects.join(exact, ["nspname", "relname"], "left_anti").alias("o").join(p, on, "left_anti")
    return exact_in.unionByName(objects.join(exact, ["nspname", "relname"], "left_anti").alias("o").join(p, on, "left_semi"))


def rule_arrays(rules: DataFrame) -> DataFrame:
    """The rules of each section as parallel lists by match class: ee_nsp, ee_rel, er_nsp, ... rr_rel (comma texts)."""
    e = {"e": "", "r": "_re"}
    out = []
    for a in "er":
        for b in "er":
            nsp, rel = F.col(f"nspname{e[a]}"), F.col(f"relname{e[b]}")
            has = nsp.isNotNull() & rel.isNotNull()
            pairs = F.array_sort(F.collect_list(F.when(has, F.struct(nsp.alias("n"), rel.alias("r")))))
            out += [F.array_join(F.transform(pairs, lambda p: p["n"]), ",").alias(f"{a}{b}_nsp"), F.array_join(F.transform(pairs, lambda p: p["r"]), ",").alias(f"{a}{b}_rel")]
    return rules.groupBy("section").agg(*out)


def schema_array(rules: DataFrame, section: str, patterns: bool = False) -> DataFrame:
    """The schema names or patterns of a section as one list; no row if there are none."""
    c = "nspname_re" if patterns else "nspname"
    return rules.where(F.col("section") == section).groupBy("section").agg(F.array_join(F.array_sort(F.collect_list(c)), ",").alias("names"), F.count(c).alias("n")).where("n > 0")


def resolve(rules: Rules, tables: DataFrame) -> DataFrame:
    """Exact rules with the oid of the table they name: (section, nspname, relname, oid).

    A table to include that isn't there is an error; one to exclude does nothing.
    """
    spark = tables.sparkSession
    exact = [(r.section, r.nspname, r.relname) for r in rules.rules if r.nspname is not None and r.relname is not None and r.section != "exclude-index"]
    frame = spark.createDataFrame(exact, "section string, nspname string, relname string")
    found = frame.join(tables.select("nspname", "relname", "oid"), ["nspname", "relname"], "left").select("section", "nspname", "relname", "oid")
    missing = found.where("oid IS NULL AND section = 'include-only-table'").collect()
    if missing:
        raise RuleError("no such tables: " + ", ".join(sorted(f"{r.nspname}.{r.relname}" for r in missing)))
    return found


def filtered_objects(parts: dict[str, tuple[int, DataFrame]]) -> DataFrame:
    """(catoid, oid, restore_list_name, kind): the skipped objects of several kinds as one relation.

    parts: by kind, the catalog's oid and rows (oid, restore_list_name). The pair of oids tells apart objects of
    different catalogs.
    """
    return reduce(DataFrame.unionByName, [df.select(F.lit(c).cast("long").alias("catoid"), F.col("oid").cast("long").alias("oid"), "restore_list_name", F.lit(kind).alias("kind")) for kind, (c, df) in parts.items()]).distinct()


def is_filtered(items: DataFrame, filtered: DataFrame) -> DataFrame:
    """items (catoid, oid, restore_list_name) with the flag filtered: by both oids, else by oid alone where the catalog isn't known, else by name."""
    pair = filtered.where("oid > 0").select("catoid", "oid", F.lit(True).alias("by_pair")).distinct()
    alone = filtered.where("oid > 0").select("oid", F.lit(True).alias("by_oid")).distinct()
    named = filtered.where("restore_list_name IS NOT NULL").select("restore_list_name", F.lit(True).alias("by_name")).distinct()
    x = items.join(pair, ["catoid", "oid"], "left").join(alone, "oid", "left").join(named, "restore_list_name", "left")
    has = lambda c: F.coalesce(c, F.lit(False))
    flag = has("by_pair") | (has("by_oid") & (F.col("catoid") == 0)) | (has("by_name") & (F.col("oid") == 0))
    return x.withColumn("filtered", flag).drop("by_pair", "by_oid", "by_name")


def sequences_in_scope(sequences: DataFrame, tables: DataFrame) -> DataFrame:
    """Sequences that selected tables own or use as a default, or that nothing owns in a selected schema.

    sequences: oid, nspname, ownedby, attrelid; tables: oid, nspname of the selected ones.
    """
    t = tables.select(F.col("oid").alias("t"))
    owned = sequences.where("ownedby IS NOT NULL").join(t, F.col("ownedby") == F.col("t"), "left_semi")
    used = sequences.where("attrelid IS NOT NULL").join(t, F.col("attrelid") == F.col("t"), "left_semi")
    free = sequences.where("ownedby IS NULL AND attrelid IS NULL").join(tables.select("nspname").distinct(), "nspname", "left_semi")
    return reduce(DataFrame.unionByName, [owned, used, free.select(*sequences.columns)]).distinct()
