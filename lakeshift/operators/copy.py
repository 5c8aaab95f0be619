"""Bulk copies of tables into folders: by parts, idempotent, to be resumed, verified afterwards.

Each part is written to its own folder (overwritten when tried again) and then noted as done; a table is complete when
all of its parts are. A run that goes on copies only what isn't noted.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.operators.compare import compare_data
from lakeshift.operators.split import Part, scan

DONE = "table_name string, partnum int, partcount int, rows long, duration_ms long, done_time double"


@dataclass
class Target:
    """A folder of tables, with the notes of what is done."""

    spark: SparkSession
    path: str

    def part_path(self, table: str, part: Part) -> str:
        return f"{self.path}/{table}/part={part.partnum}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def done(self) -> DataFrame:
        """The notes of this run and of those before."""
        fs, p = self._fs(f"{self.path}/_done")
        return self.spark.read.schema(DONE).json(str(p)) if fs.exists(p) else self.spark.createDataFrame([], DONE)

    def note(self, table: str, part: Part, rows: int, duration_ms: int) -> None:
        """One small file for each part, so that writers never meet; it appears once the part is complete."""
        fs, p = self._fs(f"{self.path}/_done/{table}-{part.partnum}-{part.partcount}.json")
        out = fs.create(p, True)
        out.write(bytearray(json.dumps({"table_name": table, "partnum": part.partnum, "partcount": part.partcount, "rows": rows, "duration_ms": duration_ms, "done_time": time.time()}).encode()))
        out.close()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}").drop("part")


def with_retries(work: Callable[[], None], attempts: int = 5, wait: float = 2.0, transient: tuple = (OSError,)) -> int:
    """Runs the work again after transient errors only; the number of attempts."""
    for k in range(1, attempts + 1):
        try:
            work()
            return k
        except transient:
            if k == attempts:
                raise
            time.sleep(wait)
    raise AssertionError


def copy_part(df: DataFrame, target: Target, name: str, part: Part, key: str | None) -> None:
    began = time.time()
    rows = scan(df, part, key) if key is not None else df
    path = target.part_path(name, part)
    with_retries(lambda: rows.write.mode("overwrite").parquet(path))
    n = target.spark.read.parquet(path).count()  # of the files' footers
    target.note(name, part, n, int(1000 * (time.time() - began)))


def copy_tables(tables: dict[str, tuple[DataFrame, list[Part], str | None]], target: Target, workers: int = 4, resume: bool = False) -> DataFrame:
    """Copies tables (frame, parts, split key), several parts at a time, those of many parts first; returns the notes."""
    finished = {(r.table_name, r.partnum, r.partcount) for r in target.done().collect()} if resume else set()
    todo = [(n, p, df, k) for n, (df, parts, k) in sorted(tables.items(), key=lambda t: -len(t[1][1])) for p in parts if (n, p.partnum, p.partcount) not in finished]
    with ThreadPoolExecutor(workers) as pool:
        for f in [pool.submit(copy_part, df, target, n, p, k) for n, p, df, k in todo]:
            f.result()
    return target.done()


def copied_at_once(df: DataFrame, path: str, parts: list[Part], key: str) -> None:
    """All parts in one pass: a folder for each, as few files as parts."""
    from lakeshift.operators.split import deal

    deal(df, parts, key).write.mode("overwrite").partitionBy("partnum").parquet(path)


def verified(source: dict[str, DataFrame], target: Target) -> DataFrame:
    """The comparison that a copy must pass."""
    return compare_data(source, {n: target.table(n) for n in source}, portable=False)


def sequences_reset(sequences: DataFrame, maxima: dict[str, int]) -> DataFrame:
    """Sequences (relname, last_value, is_called) set to what their tables have reached."""
    spark = sequences.sparkSession
    m = spark.createDataFrame(list(maxima.items()), "relname string, reached long")
    x = sequences.join(m, "relname", "left")
    return x.select("relname", F.greatest("last_value", F.coalesce("reached", "last_value")).alias("last_value"), (F.col("is_called") | F.col("reached").isNotNull()).alias("is_called"))


def schema_json(tables: dict[str, DataFrame]) -> str:
    """The tables' schemas as one JSON document."""
    return json.dumps({"tables": [{"name": n, "columns": [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in df.schema.fields]} for n, df in tables.items()]})


def analyzed(spark: SparkSession, table: str) -> None:
    """Statistics after a load."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
