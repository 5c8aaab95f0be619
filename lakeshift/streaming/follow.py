"""Following a log to an end position: control events in a shared folder, and a loop that runs the applier again.

Anyone may set the end position or switch applying on and off while a follower runs; positions that workers note only
move forward. The follower restarts a query that fails, as long as it makes progress.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from lakeshift.streaming.state import sentinel
from lakeshift.streaming.stream import Applier

EVENT = "seq long, startpos long, endpos long, apply boolean, write_lsn long, flush_lsn long, replay_lsn long"


class Control:
    """The control state below a path: a small file for each event, read as one row."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def set(self, **values) -> None:
        """Any of startpos, endpos, apply, write_lsn, flush_lsn and replay_lsn."""
        event = {"seq": time.time_ns()} | values
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{event['seq']}-{uuid.uuid4().hex}.json")
        out = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(p, False)
        out.write(bytearray(json.dumps(event).encode()))
        out.close()

    def get(self) -> dict:
        row = sentinel(self.spark.read.schema(EVENT).json(self.path)).first()
        return {"startpos": row.startpos or 0, "endpos": row.endpos or 0, "apply": bool(row["apply"]), "write_lsn": row.write_lsn, "flush_lsn": row.flush_lsn, "replay_lsn": row.replay_lsn}


def follow(control: Control, applier: Applier, stream: Callable[[], DataFrame], checkpoint: str, restarts: int = 3, at_end: Callable[[], None] | None = None) -> str:
    """Applies what is there until nothing comes, or until the end position is reached.

    Returns "waiting" (applying is off), "caught up", or "done"; at_end (sequences aren't in the log) runs before "done".
    """
    failures = 0
    while True:
        state = control.get()
        if not state["apply"]:
            return "waiting"
        before, applier.endpos = applier.cursor(), state["endpos"]
        try:
            applier.run(stream(), checkpoint).awaitTermination()
        except StreamingQueryException:
            failures = 0 if applier.cursor() > before else failures + 1
            if failures > restarts:
                raise
            continue
        control.set(replay_lsn=applier.cursor())
        if state["endpos"] and applier.cursor() >= state["endpos"]:
            if at_end is not None:
                at_end()
            return "done"
        if applier.cursor() == before:
            return "caught up"
