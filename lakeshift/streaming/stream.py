"""The applier as a Structured Streaming query: complete transactions are folded into versions of a state.

The state lies in buckets of keys. Each micro-batch writes a new version of the buckets that its changes touch, the
messages of transactions that haven't ended, and a note with the position and the version of each bucket; all become
visible together when the note is written. A batch of the same checkpoint that is run again finds its note and does
nothing; with another checkpoint, or none, positions decide: transactions that end at or before the state's position
are passed over, and messages that come again count once. So results are exactly once however often a stream is begun
anew. What a batch costs depends on the buckets that it touches, not on the whole state. Versions that neither of the
last two notes needs are removed.

As positions decide, batches must come in the order of the log (within a batch, order doesn't matter). A stream of files
takes them by their times of modification: files that tasks write side by side have those of their last bytes, in any
order. ``run_segments`` appends one segment of the log after another, and applies each before the next is there.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.streaming.apply import merged
from lakeshift.streaming.transactions import in_commit_order, last_delivery, transactions


class Applier:
    """Folds a change log (id, action, xid, lsn, key and value columns) into a state of one relation below a path.

    unchanged: for a column, where it wasn't sent. endpos: apply the transaction that holds it, then nothing more.
    buckets: into how many the keys are hashed; it can't change for a path.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], columns: list[str], unchanged: dict[str, Column] | None = None, endpos: int = 0, buckets: int = 64):
        self.checkpoint: str | None = None
        self.spark, self.path, self.key, self.columns, self.unchanged, self.endpos, self.buckets = spark, path, key, columns, unchanged, endpos, buckets

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def versions(self) -> list[int]:
        return sorted(int(n.removeprefix("done-")) for n in self._names(self.path) if n.startswith("done-"))

    def note(self, version: int) -> dict:
        return json.loads(self.spark.read.option("wholetext", True).text(f"{self.path}/done-{version:012d}").first()[0])

    def _remove(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _prune(self) -> None:
        """Removes what the last two notes don't need."""
        kept = self.versions()[-2:]
        needed = {*kept, *(v for k in kept for v in self.note(k)["buckets"].values())}
        for name in self._names(self.path):
            kind, _, number = name.partition("-" if name.startswith("done-") else "=")
            if (kind == "v" and int(number) < kept[-1] and int(number) not in needed) or (kind == "done" and int(number) not in kept):
                self._remove(f"{self.path}/{name}")

    def _mark(self, version: int, note: dict) -> None:
        fs, p = self._fs(f"{self.path}/done-{version:012d}")
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(note).encode()))
        out.close()

    def _last(self) -> dict:
        v = self.versions()
        return self.note(v[-1]) | {"version": v[-1]} if v else {"replay_lsn": 0, "stopped": False, "buckets": {}, "schema": None, "version": None}

    def _read(self, note: dict, only: set[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(note["schema"])
        paths = [f"{self.path}/v={v:012d}/state/bucket={b}" for b, v in note["buckets"].items() if only is None or int(b) in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def state(self) -> DataFrame | None:
        note = self._last()
        return self._read(note) if note["version"] is not None else None

    def cursor(self) -> int:
        return self._last()["replay_lsn"]

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        note = self._last()
        if note["version"] is not None and note["checkpoint"] == self.checkpoint and note["batch"] >= batch_id:
            return
        version = 0 if note["version"] is None else note["version"] + 1
        log = batch
        if note["version"] is not None:
            log = self.spark.read.schema(batch.schema).parquet(f"{self.path}/v={note['version']:012d}/pending").unionByName(batch)
        log = last_delivery(log).persist()
        txn = transactions(log).persist()
        ready = txn.where((F.col("outcome") != "open") & (F.col("end_lsn") > note["replay_lsn"]))
        if self.endpos:
            ready = ready.where(F.col("begin_lsn") <= self.endpos)
        if note["stopped"]:
            ready = ready.where(F.lit(False))
        out = f"{self.path}/v={version:012d}"
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        changes = in_commit_order(log).join(ready.select("xid"), "xid", "left_semi")
        schema = changes.select(*self.key, *self.columns).schema
        note["schema"] = note["schema"] or json.loads(schema.json())
        seen = changes.select(F.when(F.col("action") != "T", bucket).alias("bucket")).distinct().collect()  # as many as buckets
        touched = {r.bucket for r in seen if r.bucket is not None}
        if any(r.bucket is None for r in seen):  # a truncation
            touched |= {int(b) for b in note["buckets"]}
        if touched:
            rows = merged(self._read(note, touched), changes, self.key, self.columns, ["commit_lsn", "id"], self.unchanged)
            rows.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{out}/state")
        kept = {b: v for b, v in note["buckets"].items() if int(b) not in touched}
        written = {n.removeprefix("bucket="): version for n in self._names(f"{out}/state") if n.startswith("bucket=")}
        log.join(txn.where("outcome = 'open'").select("xid"), "xid", "left_semi").select(*batch.columns).write.mode("overwrite").parquet(f"{out}/pending")
        last = ready.agg(F.max("end_lsn")).first()[0] or note["replay_lsn"]
        self._mark(version, {"checkpoint": self.checkpoint, "batch": batch_id, "replay_lsn": last, "stopped": note["stopped"] or bool(self.endpos and last >= self.endpos), "buckets": kept | written, "schema": note["schema"]})
        self._prune()
        log.unpersist()
        txn.unpersist()

    def run(self, stream: DataFrame, checkpoint: str, available_now: bool = True):
        """Starts the query; with available_now it ends when all that is there was applied."""
        self.checkpoint = checkpoint
        writer = stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")).start()

    def run_segments(self, segments: Iterable[DataFrame], log: str, checkpoint: str) -> None:
        """Appends each segment of a log, in its order, to the folder ``log`` and applies it as one batch of the folder's stream.

        A segment may take several files.
        """
        for segment in segments:
            segment.write.mode("append").parquet(log)
            self.run(self.spark.readStream.schema(segment.schema).parquet(log), checkpoint).awaitTermination()
