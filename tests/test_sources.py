import json

import pytest
from pyspark.sql import functions as F

from lakeshift.operators.filters import is_filtered
from lakeshift.operators.session import Sections, Setup, SetupError
from lakeshift.sources import readers
from lakeshift.sources.replication import ChangeLog, position
from lakeshift.sources.rules import parse_rules

LINES = [
    {"action": "B", "xid": "7", "lsn": "0/10", "message": "BEGIN 7"}, {"action": "I", "xid": "7", "lsn": "0/11", "message": "table public.t: INSERT: a[integer]:1"},
    {"action": "C", "xid": "7", "lsn": "0/12", "message": "COMMIT 7"}, {"action": "X", "lsn": "1/0"}, {"action": "B", "xid": "8", "lsn": "1/5", "message": "BEGIN 8"},
]


def test_copy_text_round_trip(spark):
    df = spark.createDataFrame([(1, "a\tb\\n\n", True, 0.5), (2, None, None, None), (3, "\\N", False, -1.0), (4, "", True, 2.0), (5, "\\t\x0b\r", None, 0.0)], "k int, t string, b boolean, x double")
    lines = readers.copy_text(df)
    assert all("\n" not in r.line for r in lines.collect())
    assert sorted(map(tuple, readers.from_copy_text(lines, df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_change_log_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, LINES)))
    rows = readers.change_log(spark, str(tmp_path)).collect()
    assert [r.lsn for r in rows] == [16, 17, 18, 1 << 32, (1 << 32) + 5] and rows[3].xid is None
    assert readers.change_log_stream(spark, str(tmp_path)).isStreaming


def test_streaming_source(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    for n in range(2):
        (log / f"{n}.json").write_text("\n".join(map(json.dumps, LINES[3 * n : 3 * n + 3])) + "\n")
    spark.dataSource.register(ChangeLog)
    out = []
    stream = spark.readStream.format("changelog").option("path", str(log)).option("messages", 2).option("feedback", str(tmp_path / "fed")).load()
    q = stream.writeStream.foreachBatch(lambda df, _: out.extend(map(tuple, df.collect()))).option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert [r[0] for r in out] == [1, 2, 3, 4, 5] and out[1][3] == position("0/11") and out[3][2] is None
    assert json.loads((tmp_path / "fed").read_text())["n"] >= 2


def test_large_objects(spark, tmp_path):
    for k, n in ((101, 5), (102, 0), (103, 40)):
        (tmp_path / f"{k}.blob").write_bytes(bytes(range(n)))
    x = readers.large_objects(spark, str(tmp_path))
    assert {r.oid: r.bytes for r in x.collect()} == {101: 5, 103: 40}
    p = readers.object_pieces(x, 16)
    assert p.count() == 4
    again = p.groupBy("oid").agg(F.array_sort(F.collect_list(F.struct("piece", "content"))).alias("p")).collect()
    assert {r.oid: b"".join(bytes(c.content) for c in r.p) for r in again} == {101: bytes(range(5)), 103: bytes(range(40))}
    (tmp_path / "out").mkdir()
    assert readers.write_objects(x, str(tmp_path / "out")).agg(F.sum("bytes")).first()[0] == 45 and (tmp_path / "out/103").stat().st_size == 40


def test_archive_lists(spark):
    text = [";", "; Archive created", "12; 1259 16385 TABLE public film postgres", "13; 0 16385 TABLE DATA public film postgres", ";14; 1259 9 INDEX public film idx postgres", "", "3; 2615 2200 SCHEMA - public postgres"]
    e = readers.archive_entries(spark.createDataFrame([(t,) for t in text], "value string"))
    assert {(r.dump_id, r.description, r.restore_list_name, r.skipped) for r in e.collect()} == {(12, "TABLE", "public film postgres", False), (13, "TABLE DATA", "public film postgres", False), (14, "INDEX", "public film idx postgres", True), (3, "SCHEMA", "- public postgres", False)}
    f = spark.createDataFrame([(1259, 16385, "public film postgres", "table")], "catoid long, oid long, restore_list_name string, kind string")
    lines = {r.dump_id: r.line for r in readers.restore_list(is_filtered(e, f)).collect()}
    assert lines[12].startswith(";12; 1259") and lines[13].startswith(";13; 0") and lines[3].startswith("3; 2615")


def test_small_things(spark):
    t = spark.createDataFrame([("public", "b"), ("Odd one", "a")], "nspname string, relname string")
    assert readers.publication("p", t) == 'CREATE PUBLICATION "p" FOR TABLE "Odd one".a, public.b'
    assert readers.publication("p", t.limit(0)) == 'CREATE PUBLICATION "p"'
    assert readers.extension_requirements(spark, '[{"name":"x","version":"1.2"}]').first() == ("x", "1.2")


def test_setups():
    a = Setup.of("postgres://u:secret@h/db", "t", parse_rules("[exclude-schema]\nx\n"), snapshot="1")
    assert "secret" not in a.source and a.digest == Setup.of("postgres://u:other@h/db", "t", parse_rules("[exclude-schema]\nx\n"), snapshot="1").digest
    b = Setup.of("postgres://u@h/db", "t", parse_rules("[exclude-schema]\ny\n"), snapshot="1")
    with pytest.raises(SetupError):
        b.check(a)
    c = Setup.of("postgres://u:secret@h/db", "t", parse_rules("[exclude-schema]\nx\n"), snapshot="2")
    c.check(a, consistent=False)
    with pytest.raises(SetupError):
        c.check(a)
    s = Sections()
    s.done("tables", 5)
    s.log("clone")
    assert s.missing(["tables", "indexes"]) == ["indexes"] and s.total_ms() == 5 and s.commands[0][1] == "clone"
