"""Catalogs that last: relations as folders of numbered batches of events, snapshots of tables, clones of databases.

Nothing is updated in place. A batch puts rows (all of their columns count), changes some columns of rows, or removes rows
by key or all of them; a relation's state is the fold of its batches in order, as one aggregation (see streaming.apply).
A batch's folder appears with its files or not at all, and a run that goes on reads what earlier ones left.
"""

from __future__ import annotations

import json
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.operators.catalog import CatalogSet
from lakeshift.operators.compare import compare_data
from lakeshift.operators.copy import Target, copy_tables, sequences_reset
from lakeshift.operators.split import Part
from lakeshift.streaming.apply import fold, last_truncation

#: The keys of the relations.
KEYS = {
    "s_table": ["oid"], "s_attr": ["oid", "attnum"], "s_index": ["oid"], "s_constraint": ["oid"], "s_table_part": ["oid", "partnum"], "s_table_chksum": ["oid"], "s_table_size": ["oid"],
    "s_matview": ["oid"], "s_seq": ["oid"], "s_database": ["oid"], "s_database_property": ["datname", "rolname", "name"], "s_coll": ["oid"], "s_namespace": ["oid"], "s_extension": ["oid"],
    "s_extension_config": ["extoid", "reloid"], "s_extension_versions": ["oid"], "s_role": ["oid"], "s_depend": ["classid", "objid", "refclassid", "refobjid", "deptype"], "timeline_history": ["tli"],
    "catname": ["datname"], "filter": ["oid", "restore_list_name", "kind"], "process": ["pid"], "summary": ["tableoid", "partnum"], "index_summary": ["oid"], "constraint_summary": ["oid"],
    "vacuum_summary": ["tableoid"], "extension_summary": ["oid"],
}


class Store:
    """Relations (see KEYS) below a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _batches(self, relation: str) -> list[int]:
        fs, p = self._fs(f"{self.path}/{relation}")
        names = [s.getPath() for s in fs.listStatus(p)] if fs.exists(p) else []
        done = [n for n in names if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(n, "_SUCCESS"))]
        return sorted(int(n.getName().removeprefix("batch=")) for n in done)

    def _write(self, relation: str, rows: DataFrame, action: str, sent: list[str] | None = None) -> None:
        batch = max(self._batches(relation), default=-1) + 1
        sent_ = F.array(*map(F.lit, sent)) if sent else F.lit(None).cast("array<string>")
        rows.withColumn("_action", F.lit(action)).withColumn("_sent", sent_).write.mode("overwrite").parquet(f"{self.path}/{relation}/batch={batch}")

    def add(self, relation: str, rows: DataFrame) -> None:
        """Inserts rows, many at once; those of a key that is there replace it."""
        self._write(relation, rows, "I")

    def add_new(self, relation: str, rows: DataFrame) -> None:
        """Inserts rows whose keys aren't there yet; the others are passed over."""
        there = self.state(relation)
        keys = KEYS[relation]
        self.add(relation, rows.dropDuplicates(keys) if there is None else rows.dropDuplicates(keys).join(there.select(*keys), keys, "left_anti"))

    def change(self, relation: str, rows: DataFrame) -> None:
        """Sets the other columns of rows by key; columns that rows don't have stay."""
        self._write(relation, rows, "U", [c for c in rows.columns if c not in KEYS[relation]])

    def remove(self, relation: str, keys: DataFrame | None = None) -> None:
        """Removes rows by key, or all."""
        keys = self.spark.createDataFrame([(None,)], "_none int") if keys is None else keys
        self._write(relation, keys, "T" if "_none" in keys.columns else "D")

    def state(self, relation: str) -> DataFrame | None:
        """The relation's rows now; None if nothing was ever written."""
        batches = self._batches(relation)
        if not batches:
            return None
        paths = [f"{self.path}/{relation}/batch={b}" for b in batches]
        events = self.spark.read.option("mergeSchema", True).option("basePath", f"{self.path}/{relation}").parquet(*paths).withColumnRenamed("_action", "action")
        keys = KEYS[relation]
        columns = [c for c in events.columns if c not in (*keys, "action", "_sent", "batch", "_none")]
        unsent = {c: ~F.array_contains("_sent", c) for c in columns}  # null, so sent, where all were
        return fold(events, keys, columns, ["batch"], unsent, last_truncation(events, ["batch"]))

    def catalog(self) -> CatalogSet:
        """All relations that there are."""
        fs, p = self._fs(self.path)
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return CatalogSet({n: self.state(n) for n in names if n in KEYS})

    def started(self, relation: str, rows: DataFrame, at: float | None = None) -> None:
        """Notes work that begins (tables, indexes, constraints, vacuums, extensions: rows with the relation's key)."""
        self.add(relation, rows.withColumn("start_time", F.lit(time.time() if at is None else at)).withColumn("done_time", F.lit(None).cast("double")))

    def finished(self, relation: str, rows: DataFrame, at: float | None = None) -> None:
        """Notes work that has ended; other columns of rows are its figures."""
        self.change(relation, rows.withColumn("done_time", F.lit(time.time() if at is None else at)))


def databases(tables: DataFrame) -> DataFrame:
    """(datname, tables, bytes) of tables (datname, bytes), by name."""
    return tables.groupBy("datname").agg(F.count("*").alias("tables"), F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("bytes")).orderBy("datname")


def database_properties(settings: DataFrame) -> DataFrame:
    """(datname, rolname, name, value) of settings (datname, rolname, setconfig: "name=value" texts); a value may hold "="."""
    x = settings.select("datname", "rolname", F.explode("setconfig").alias("s"))
    return x.select("datname", "rolname", F.substring_index("s", "=", 1).alias("name"), F.expr("substring(s, instr(s, '=') + 1)").alias("value"))


def roles(rows: DataFrame) -> DataFrame:
    """Roles (oid, rolname) but for the system's own, by name."""
    return rows.where(~F.col("rolname").startswith("pg_")).select("oid", "rolname").orderBy("rolname")


class Snapshot:
    """The files that tables consist of at one time: whoever has it reads the same rows, whatever is written meanwhile."""

    def __init__(self, spark: SparkSession, files: dict[str, list[str]]):
        self.spark, self.files = spark, files

    @classmethod
    def export(cls, spark: SparkSession, tables: dict[str, str]) -> Snapshot:
        """Of tables by the path of their Parquet files."""
        return cls(spark, {n: sorted(spark.read.parquet(p).inputFiles()) for n, p in tables.items()})

    def save(self, path: str) -> None:
        self.spark.createDataFrame([(json.dumps(self.files),)], "value string").coalesce(1).write.text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Snapshot:
        return cls(spark, json.loads(spark.read.option("wholetext", True).text(path).first()[0]))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(*self.files[name])


def clone_databases(spark: SparkSession, sources: dict[str, dict[str, DataFrame]], path: str, sequences: dict[str, tuple[DataFrame, dict[str, int]]] | None = None, resume: bool = False, workers: int = 4) -> DataFrame:
    """Copies all tables of all databases below a path, sets sequences to what their tables have reached, and compares.

    sequences: by database, (relname, last_value, is_called) and the tables' maxima. Returns (datname, table_name,
    source_rows, target_rows, status); a run that goes on copies what isn't noted as done.
    """
    reports = []
    for name, tables in sources.items():
        target = Target(spark, f"{path}/{name}")
        copy_tables({t: (df, [Part(1, 1)], None) for t, df in tables.items()}, target, workers, resume)
        if sequences and name in sequences:
            sequences_reset(*sequences[name]).write.mode("overwrite").parquet(f"{path}/{name}/_sequences")
        report = compare_data(tables, {t: target.table(t) for t in tables})
        reports.append(report.select(F.lit(name).alias("datname"), "table_name", "source_rows", "target_rows", "status"))
    return reduce(DataFrame.unionByName, reports)
