"""Catalog relations of a set of tables, and the queries over them: lists, statistics, lookups, candidates for keys."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakeshift.functions.text import one_line, qualified

S_TABLE = "oid long, datname string, nspname string, relname string, amname string, relkind string, persistence string, bytes long, reltuples long"
S_ATTR = "oid long, nspname string, relname string, attnum int, attname string, typname string, attisprimary boolean, attisgenerated boolean, attidentity string"
#: Types that a binary copy carries without risk.
BINARY_SAFE = (T.LongType, T.IntegerType, T.ShortType, T.DoubleType, T.FloatType, T.StringType, T.BooleanType, T.TimestampType, T.TimestampNTZType, T.DateType, T.DecimalType, T.BinaryType)


@dataclass
class CatalogSet:
    """Relations by name (s_table, s_attr, s_index, ...), one set for each of source, target and filter."""

    relations: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.relations[name]

    def lookup(self, relation: str, **key) -> DataFrame:
        """Rows by key, as in lookup("s_table", nspname="public", relname="orders")."""
        return self[relation].where(reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in key.items()], F.lit(True)))

    def iterate(self, relation: str, *order: str):
        """Rows in order, on the driver, a partition at a time: catalogs are small beside their tables."""
        return self[relation].orderBy(*order).toLocalIterator()


def of_frames(spark: SparkSession, tables: dict[str, DataFrame], nspname: str = "public", datname: str = "main", keys: dict[str, list[str]] | None = None, first_oid: int = 16384) -> CatalogSet:
    """The relations s_table and s_attr of Spark tables: schemas are known, sizes are Catalyst's estimates."""
    t, a = [], []
    for k, (name, df) in enumerate(tables.items()):
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # a number or a big one
        t.append((first_oid + k, datname, nspname, name, "heap", "r", "p", size, None))
        primary = (keys or {}).get(name, [])
        a += [(first_oid + k, nspname, name, n, f.name, f.dataType.simpleString(), f.name in primary, False, "") for n, f in enumerate(df.schema.fields, 1)]
    return CatalogSet({"s_table": spark.createDataFrame(t, S_TABLE), "s_attr": spark.createDataFrame(a, S_ATTR)})


def binary_safe(df: DataFrame) -> bool:
    """Whether all columns, and what arrays and structs hold, can be copied in binary."""

    def safe(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return safe(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(safe(f.dataType) for f in kind.fields)
        return isinstance(kind, BINARY_SAFE)

    return safe(df.schema)


def all_binary_safe(attrs: DataFrame, safe: Column) -> DataFrame:
    """(oid, safe): whether all of a table's columns are safe."""
    return attrs.groupBy("oid").agg(F.bool_and(safe).alias("safe"))


def restore_name(nspname: Column, relname: Column, owner: Column) -> Column:
    return F.concat_ws(" ", one_line(nspname), one_line(relname), one_line(owner))


def list_tables(tables: DataFrame) -> DataFrame:
    """Tables with their quoted names, the largest first."""
    return tables.withColumn("qname", qualified(F.col("nspname"), F.col("relname"))).orderBy(F.desc("bytes"), "nspname", "relname")


def attribute_lists(attrs: DataFrame) -> DataFrame:
    """(oid, attrs): the names of the columns that are copied, in order; generated ones aren't."""
    listed = F.expr("string_agg(attname, ', ') WITHIN GROUP (ORDER BY attnum) FILTER (WHERE NOT attisgenerated)")
    return attrs.groupBy("oid").agg(listed.alias("attrs"))


def tables_without_key(tables: DataFrame, attrs: DataFrame) -> DataFrame:
    keyed = attrs.groupBy("oid").agg(F.sum(F.col("attisprimary").cast("int")).alias("n")).where("n = 0")
    return tables.join(keyed, "oid", "left_semi")


def tables_with_generated(tables: DataFrame, attrs: DataFrame) -> DataFrame:
    n = F.sum(F.when(F.col("attisgenerated"), 1).otherwise(0))
    return tables.join(attrs.groupBy("oid").agg(n.alias("n")).where("n > 0"), "oid", "left_semi")


def split_key(indexes: DataFrame) -> DataFrame:
    """(tableoid, attname): for each table the best single integer column of a unique index, primary first, then by name.

    indexes: tableoid, indexname, isprimary, isunique, columns (array), types (array).
    """
    one = indexes.where("isunique AND size(columns) = 1").where(F.element_at("types", 1).isin("smallint", "int", "bigint", "int2", "int4", "int8"))
    best = Window.partitionBy("tableoid").orderBy(~F.col("isprimary"), "indexname")
    return one.withColumn("k", F.row_number().over(best)).where("k = 1").select("tableoid", F.element_at("columns", 1).alias("attname"))


def unique_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n, n_distinct, n_null, is_unique) for each column: one shuffle of (column, value) counts."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("x")).select("x.*")
    per = long.groupBy("column_name", "v").agg(F.count("*").alias("n"))
    return per.groupBy("column_name").agg(F.sum("n").cast("long").alias("n"), F.count("v").alias("n_distinct"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("n_null"), F.max(F.when(F.col("v").isNotNull(), F.col("n"))).alias("most")).select("column_name", "n", "n_distinct", "n_null", (F.coalesce(F.col("most"), F.lit(2)) == 1).alias("is_unique"))


def table_stats(tables: DataFrame, attrs: DataFrame, indexes: DataFrame | None = None) -> DataFrame:
    """One row of counts and sums; children are counted before the join, so that sums aren't multiplied."""
    x = tables.join(attrs.groupBy("oid").agg(F.count("*").alias("n_attrs")), "oid", "left")
    if indexes is not None:
        x = x.join(indexes.groupBy(F.col("tableoid").alias("oid")).agg(F.count("*").alias("n_indexes")), "oid", "left")
    else:
        x = x.withColumn("n_indexes", F.lit(0).cast("long"))
    return x.agg(F.count("*").alias("tables"), F.coalesce(F.sum("n_attrs"), F.lit(0)).alias("attrs"), F.coalesce(F.sum("n_indexes"), F.lit(0)).alias("indexes"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("reltuples"), F.lit(0)).alias("tuples"))


def object_counts(relations: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of each relation."""
    return reduce(lambda a, b: a.crossJoin(b), [df.agg(F.count("*").alias(n)) for n, df in relations.items()])  # rows of one


def index_definitions(indexes: DataFrame) -> DataFrame:
    """CREATE INDEX commands; if_not_exists as for a run that goes on."""
    cols = F.array_join("columns", ", ")
    head = F.concat(F.lit("CREATE "), F.when(F.col("isunique"), "UNIQUE ").otherwise(""), F.lit("INDEX "))
    body = F.concat(F.lit(" ON "), qualified(F.col("nspname"), F.col("tablename")), F.lit(" ("), cols, F.lit(")"))
    name = F.col("indexname")
    return indexes.withColumn("sql", F.concat(head, name, body)).withColumn("sql_if_not_exists", F.concat(head, F.lit("IF NOT EXISTS "), name, body))


def constraint_command(table: Column, conname: Column, contype: Column, definition: Column, indexname: Column, deferrable: Column, deferred: Column) -> Column:
    """ALTER TABLE for a constraint: primary keys and unique ones take over their index, others have their definition."""
    using = F.when(contype == "p", F.concat(F.lit("PRIMARY KEY USING INDEX "), indexname)).when(contype == "u", F.concat(F.lit("UNIQUE USING INDEX "), indexname)).otherwise(definition)
    tail = F.concat(F.when(deferrable, " DEFERRABLE").otherwise(""), F.when(deferred, " INITIALLY DEFERRED").otherwise(""))
    return F.concat(F.lit("ALTER TABLE "), table, F.lit(" ADD CONSTRAINT "), conname, F.lit(" "), using, F.when(contype.isin("p", "u"), tail).otherwise(""))


def violated(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that a unique constraint over the columns would reject (nulls are distinct): (columns, n)."""
    has = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(has).groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def first_by(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each key in an order that decides (distinct on)."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")


def numbered(df: DataFrame, keys: list[str], *order, name: str = "rn") -> DataFrame:
    """Each group's rows with their number in an order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def co_located(tables: DataFrame) -> DataFrame:
    """Commands that distribute tables (tname, distribution_column, colocation_id, shard_count).

    Of each group, the table of the least name is distributed by itself; the others join it.
    """
    anchors = tables.groupBy("colocation_id").agg(F.min("tname").alias("anchor"))
    literal = lambda c: F.concat(F.lit("'"), F.replace(F.col(c), F.lit("'"), F.lit("''")), F.lit("'"))
    alone = F.concat(F.lit("shard_count := "), F.col("shard_count").cast("string"), F.lit(", colocate_with := 'none'"))
    how = F.when(F.col("tname") == F.col("anchor"), alone).otherwise(F.concat(F.lit("colocate_with := "), literal("anchor")))
    command = F.concat(F.lit("select create_distributed_table("), F.concat_ws(", ", literal("tname"), literal("distribution_column"), how), F.lit(")"))
    return tables.join(anchors, "colocation_id").withColumn("command", command)


def extension_versions(updates: DataFrame) -> DataFrame:
    """(extname, versions): for each extension the versions that update paths (extname, path as "a--b--c") reach, as JSON, the fewest steps first."""
    x = updates.withColumn("steps", F.size(F.split("path", "--"))).withColumn("version", F.element_at(F.split("path", "--"), -1))
    return x.groupBy("extname").agg(F.to_json(F.transform(F.array_sort(F.collect_set(F.struct("steps", "version"))), lambda v: v["version"])).alias("versions"))


def collations_in_use(parts: list[DataFrame]) -> DataFrame:
    """Collations (oid, name, used_by) of databases, columns and indexes: each once, with its first use by name."""
    return first_by(reduce(DataFrame.union, parts).distinct(), ["oid"], "name", "used_by")
