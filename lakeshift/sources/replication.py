"""A change log as a streaming source: positions are offsets, commits are the feedback to the sender.

``spark.dataSource.register(ChangeLog)``, then ``spark.readStream.format("changelog").option("path", folder)``. The
folder holds JSON-lines segments in the order of their names. Each read takes up to ``messages`` messages after the last
position; the position committed last is written to ``feedback``, as a sender would be told what it may forget.
With ``endpos`` the stream ends there: later messages are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

SCHEMA = "id long, action string, xid long, lsn long, message string"


def position(text: str) -> int:
    hi, lo = text.split("/")
    return (int(hi, 16) << 32) + int(lo, 16)


class ChangeLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changelog"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema: StructType) -> ChangeLogReader:
        return ChangeLogReader(self.options)


class ChangeLogReader(SimpleDataSourceStreamReader):
    """Offsets are numbers of messages: those of a position may be several, and ids must be ordered."""

    def __init__(self, options: dict):
        self.path, self.most = options["path"], int(options.get("messages", "1000"))
        self.feedback, self.endpos = options.get("feedback"), int(options.get("endpos", "0"))

    def _messages(self, start: int) -> Iterator[tuple]:
        n = 0
        for name in sorted(os.listdir(self.path)):
            if not name.endswith(".json"):
                continue
            with open(f"{self.path}/{name}", encoding="utf-8") as f:
                for line in f:
                    if not line.strip():
                        continue
                    n += 1
                    if n > start:
                        m = json.loads(line)
                        lsn = position(m["lsn"])
                        if self.endpos and lsn > self.endpos:
                            return
                        yield n, m["action"], int(m["xid"]) if m.get("xid") not in (None, "") else None, lsn, m.get("message")

    def initialOffset(self) -> dict:
        return {"n": 0, "lsn": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows = []
        for row in self._messages(start["n"]):
            rows.append(row)
            if len(rows) >= self.most:
                break
        end = {"n": rows[-1][0], "lsn": rows[-1][3]} if rows else start
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return (row for row in self._messages(start["n"]) if row[0] <= end["n"])

    def commit(self, end: dict) -> None:
        if self.feedback:
            with open(self.feedback, "w", encoding="utf-8") as f:
                json.dump(end, f)
