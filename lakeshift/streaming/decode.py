"""Decoding of change messages in three formats to one shape (DECODED).

JSON messages are parsed by built-in functions. The textual format quotes values by doubling, which regular
expressions can't follow safely, and the third is binary: both are read by Arrow-batched functions.

A column is a struct (section, pos, name, status, value): section N (new tuple), K (old key) or O (whole old tuple);
status t (text), n (null) or u (unchanged, not sent).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMN = "struct<section:string,pos:int,name:string,status:string,value:string>"
DECODED = f"id long, lsn long, xid long, action string, nspname string, relname string, old_type string, cols array<{COLUMN}>"
PASSED = ("B", "C", "I", "U", "D", "T", "X", "K", "E", "R")

#: JSON numbers come as texts, so that no digit is lost.
JSON_SCHEMA = "action string, xid string, schema string, `table` string, columns array<struct<name:string,type:string,value:string>>, identity array<struct<name:string,type:string,value:string>>"


def _section(array: Column, section: str) -> Column:
    make = lambda c, i: F.struct(F.lit(section).alias("section"), i.cast("int").alias("pos"), c["name"].alias("name"), F.when(c["value"].isNull(), "n").otherwise("t").alias("status"), c["value"].alias("value"))
    return F.coalesce(F.transform(array, make), F.array().cast(f"array<{COLUMN}>"))


def from_json_messages(messages: DataFrame) -> DataFrame:
    """DECODED rows of (id, lsn, message) in JSON."""
    m = messages.withColumn("j", F.from_json("message", JSON_SCHEMA))
    old = F.col("j.action").isin("U", "D")
    return m.select(
        "id", "lsn", F.col("j.xid").cast("long").alias("xid"), F.col("j.action").alias("action"), F.col("j.schema").alias("nspname"), F.col("j.table").alias("relname"),
        F.when(old & F.col("j.identity").isNotNull(), "O").alias("old_type"),
        F.concat(_section(F.col("j.columns"), "N"), _section(F.when(old, F.col("j.identity")), "O")).alias("cols"),
    ).where(F.col("action").isin(*PASSED))


class LexError(ValueError):
    pass


def quoted_end(text: str, at: int, quote: str) -> int:
    """Where a quoted run that starts at a place ends; a doubled quote is part of it."""
    k = at + 1
    while True:
        k = text.find(quote, k)
        if k < 0:
            raise LexError(f"no end of {text[at : at + 30]!r}")
        if text[k + 1 : k + 2] != quote:
            return k + 1
        k += 2


def identifier(text: str, at: int, stop: str) -> tuple[str, int]:
    """A raw name up to one of the stop characters outside quotes, and where it ends."""
    out = ""
    while at < len(text) and text[at] not in stop:
        if text[at] == '"':
            end = quoted_end(text, at, '"')
            out += text[at + 1 : end - 1].replace('""', '"')
            at = end
        else:
            out += text[at]
            at += 1
    return out, at


def type_end(text: str, at: int) -> int:
    """Where the bracketed type that starts at a place ends: brackets nest, as in [text[]], and may be quoted."""
    depth, k = 0, at
    while k < len(text):
        if text[k] == '"':
            k = quoted_end(text, k, '"')
            continue
        depth += {"[": 1, "]": -1}.get(text[k], 0)
        k += 1
        if not depth:
            return k
    raise LexError(f"no end of the type in {text[at : at + 30]!r}")


def text_columns(text: str, section: str, start: int = 0) -> list[tuple]:
    """Columns name[type]:value, with values raw, 'quoted', B'bits', null or unchanged."""
    out, at = [], 0
    text = text.strip(" ")
    while at < len(text):
        name, at = identifier(text, at, "[")
        end = type_end(text, at)
        if text[end : end + 1] != ":":
            raise LexError(f"a value is missing at {text[end : end + 30]!r}")
        at = end + 1
        if text[at : at + 1] == "'" or text[at : at + 2] == "B'":
            begin = at + (text[at] == "B")
            stop = quoted_end(text, begin, "'")
            status, value = "t", text[begin + 1 : stop - 1].replace("''", "'")
        else:
            stop = text.find(" ", at)
            stop = len(text) if stop < 0 else stop
            raw = text[at:stop]
            status = "n" if raw == "null" else "u" if raw == "unchanged-toast-datum" else "t"
            value = raw if status == "t" else None
        out.append((section, start + len(out), name, status, value))
        at = stop + 1
    return out


def text_message(message: str) -> tuple[str, str | None, str | None, str | None, list[tuple]] | None:
    """(action, nspname, relname, old_type, columns) of one message; None for what is skipped."""
    if message.startswith(("BEGIN", "COMMIT")):
        return message[0], None, None, None, []
    if not message.startswith("table "):
        return None
    nsp, at = identifier(message, 6, ".")
    rel, at = identifier(message, at + 1, ":")
    action, _, rest = message[at + 2 :].partition(":")
    if action.startswith("TRUNCATE"):
        return "T", nsp, rel, None, []
    kind = {"INSERT": "I", "UPDATE": "U", "DELETE": "D"}.get(action)
    if kind is None:
        return None
    rest = rest.strip(" ")
    if rest == "(no-tuple-data)":
        return kind, nsp, rel, None, []
    if kind == "D":
        return kind, nsp, rel, "K", text_columns(rest, "K")
    if kind == "U" and rest.startswith("old-key: "):
        cut = new_tuple_at(rest)
        return kind, nsp, rel, "K", text_columns(rest[cut + len(" new-tuple: ") :], "N") + text_columns(rest[9:cut], "K")
    return kind, nsp, rel, None, text_columns(rest, "N")


def new_tuple_at(text: str) -> int:
    """Where " new-tuple: " stands outside quotes."""
    k = 0
    while k < len(text):
        if text[k] in "'\"":
            k = quoted_end(text, k, text[k])
        elif text.startswith(" new-tuple: ", k):
            return k
        else:
            k += 1
    raise LexError("no new tuple")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["id", "lsn", "xid", "action", "nspname", "relname", "old_type", "cols"])


def _structs(columns: list[tuple]) -> list[dict]:
    return [dict(zip(("section", "pos", "name", "status", "value"), c, strict=True)) for c in columns]


def from_text_messages(messages: DataFrame) -> DataFrame:
    """DECODED rows of (id, lsn, xid, message) in the textual format."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, lsn, xid, m in zip(b["id"], b["lsn"], b["xid"], b["message"], strict=True):
                if (x := text_message(m)) is not None:
                    rows.append((i, lsn, xid, *x[:4], _structs(x[4])))
            yield _frame(rows)

    return messages.select("id", "lsn", "xid", "message").mapInPandas(read, DECODED)


def with_identity(decoded: DataFrame, keys: DataFrame) -> DataFrame:
    """Updates without an old key get one: the new tuple's identity columns (keys: nspname, relname, attnames)."""
    x = decoded.join(keys, ["nspname", "relname"], "left")
    own = F.transform(F.filter("cols", lambda c: (c["section"] == "N") & F.array_contains("attnames", c["name"])), lambda c: c.withField("section", F.lit("K")))
    lacks = (F.col("action") == "U") & F.col("old_type").isNull() & F.col("attnames").isNotNull()
    return x.select("id", "lsn", "xid", "action", "nspname", "relname", F.when(lacks, "K").otherwise(F.col("old_type")).alias("old_type"), F.when(lacks, F.concat("cols", own)).otherwise(F.col("cols")).alias("cols"))


Relation = tuple[str, str, list[tuple[str, bool]]]


def _string(data: bytes, at: int) -> tuple[str, int]:
    end = data.index(b"\0", at)
    return data[at:end].decode(), end + 1


def relation_of(data: bytes) -> tuple[int, Relation]:
    """(oid, (schema, relation, [(column, in the key)])) of a message that describes a relation."""
    (oid,) = struct.unpack_from(">I", data, 1)
    nsp, at = _string(data, 5)
    rel, at = _string(data, at)
    (n,) = struct.unpack_from(">H", data, at + 1)
    at, columns = at + 3, []
    for _ in range(n):
        name, end = _string(data, at + 1)
        columns.append((name, bool(data[at] & 1)))
        at = end + 8
    return oid, (nsp, rel, columns)


def _tuple(data: bytes, at: int, columns: list[tuple[str, bool]], section: str) -> tuple[list[tuple], int]:
    (n,) = struct.unpack_from(">H", data, at)
    at, out = at + 2, []
    for pos in range(n):
        status = chr(data[at])
        at, value = at + 1, None
        if status in "tb":
            (size,) = struct.unpack_from(">I", data, at)
            raw = data[at + 4 : at + 4 + size]
            at, value, status = at + 4 + size, raw.decode() if status == "t" else "\\x" + raw.hex(), "t"
        out.append((section, pos, columns[pos][0], status, value))
    return out, at


def change_of(data: bytes, relation: Relation | None) -> tuple | None:
    """(action, xid, lsn, nspname, relname, old_type, columns) of one message; None for what is skipped."""
    kind = chr(data[0])
    if kind == "B":
        lsn, _, xid = struct.unpack_from(">QQI", data, 1)
        return "B", xid, lsn, None, None, None, []
    if kind == "C":
        (lsn,) = struct.unpack_from(">Q", data, 2)
        return "C", None, lsn, None, None, None, []
    if kind not in "IUDT":
        return None
    if relation is None:
        raise LexError("a change of a relation that wasn't described")
    nsp, rel, columns = relation
    if kind == "T":
        return "T", None, None, nsp, rel, None, []
    at, old_type, old, new = 5, None, [], []
    if chr(data[at]) in "KO":
        old_type = chr(data[at])
        old, at = _tuple(data, at + 1, columns, old_type)
    if at < len(data) and chr(data[at]) == "N":
        new, at = _tuple(data, at + 1, columns, "N")
    if kind == "U" and old_type is None:  # the key hasn't changed: it is that of the new tuple
        keys = {n for n, is_key in columns if is_key}
        old_type, old = "K", [("K", *c[1:]) for c in new if c[2] in keys]
    return kind, None, None, nsp, rel, old_type, new + old


def truncated_oids(data: bytes) -> list[int]:
    (n,) = struct.unpack_from(">I", data, 1)
    return list(struct.unpack_from(f">{n}I", data, 6))


class BinaryReader:
    """Reads the binary messages of one stream, one after another; the last description of a relation counts."""

    def __init__(self) -> None:
        self.relations: dict[int, Relation] = {}

    def read(self, data: bytes) -> list[tuple]:
        """Rows of change_of; a truncate of several tables is several rows."""
        kind = chr(data[0])
        if kind == "R":
            oid, relation = relation_of(data)
            self.relations[oid] = relation
            return []
        oids = truncated_oids(data) if kind == "T" else [struct.unpack_from(">I", data, 1)[0]] if kind in "IUD" else [None]
        found = [change_of(data, self.relations.get(o)) for o in oids]
        return [f for f in found if f is not None]


RELATIONS = "stream long, oid long, at long, nspname string, relname string, names array<string>, keys array<boolean>"


def from_binary_messages(messages: DataFrame) -> DataFrame:
    """DECODED rows of (stream, id, lsn, xid, message), each message by itself.

    Descriptions of relations are read first, and changes are joined with the last one before them, so that a stream's
    messages may be read by many tasks. A change before its relation's first description is read with that.
    """
    kind = F.substring("message", 1, 1)
    number = lambda start: F.conv(F.hex(F.substring("message", start, 4)), 16, 10).cast("long")

    def relations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(s, i, *relation_of(bytes(m))) for s, i, m in zip(b["stream"], b["id"], b["message"], strict=True)]
            yield pd.DataFrame([(s, oid, i, nsp, rel, [c[0] for c in cs], [c[1] for c in cs]) for s, i, oid, (nsp, rel, cs) in rows], columns=["stream", "oid", "at", "nspname", "relname", "names", "keys"])

    known = messages.where(kind == b"R").select("stream", "id", "message").mapInPandas(relations, RELATIONS)
    # a relation has few descriptions: one for each change of its columns
    every = known.groupBy("stream", "oid").agg(F.array_sort(F.collect_list(F.struct("at", "nspname", "relname", "names", "keys"))).alias("all"))
    described = F.filter("all", lambda r: r["at"] < F.col("id"))
    relation = F.when(F.size(described) > 0, F.element_at(described, -1)).otherwise(F.get("all", F.lit(0)))
    oids = F.when(kind == b"T", F.transform(F.sequence(F.lit(0), number(2) - 1), lambda k: F.conv(F.hex(F.substring(F.col("message"), k.cast("int") * 4 + 7, F.lit(4))), 16, 10).cast("long"))).when(kind.isin(b"I", b"U", b"D"), F.array(number(2)))
    rest = messages.where(kind.isin(b"B", b"C", b"I", b"U", b"D", b"T")).select("stream", "id", "lsn", "xid", "message", F.explode_outer(oids).alias("oid"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, lsn, xid, m, nsp, rel, names, keys in b[["id", "lsn", "xid", "message", "nspname", "relname", "names", "keys"]].itertuples(index=False):
                x = change_of(bytes(m), None if names is None else (nsp, rel, list(zip(names, keys, strict=True))))
                action, own_xid, own_lsn, nsp, rel, old, cols = x
                out.append((i, lsn if own_lsn is None else own_lsn, xid if own_xid is None else own_xid, action, nsp, rel, old, _structs(cols)))
            yield _frame(out)

    told = rest.join(every, ["stream", "oid"], "left").select("id", "lsn", "xid", "message", relation.alias("r"))
    return told.select("id", "lsn", "xid", "message", "r.nspname", "r.relname", "r.names", "r.keys").mapInPandas(read, DECODED)


def sent_columns(cols: Column, section: str) -> Column:
    """The columns of a section that say something: not unchanged ones, nor nulls of a key."""
    keep = lambda c: (c["section"] == section) & (c["status"] != "u")
    return F.filter(cols, (lambda c: keep(c) & (c["status"] != "n")) if section == "K" else keep)


def exploded(decoded: DataFrame) -> DataFrame:
    """A row for each column: (output_id, section, pos, name, status, value)."""
    return decoded.select(F.col("id").alias("output_id"), F.inline("cols"))
