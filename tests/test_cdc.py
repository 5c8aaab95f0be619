import json
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeshift.plans.cdc_queries import binary_message, relation_message
from lakeshift.streaming import decode, state, statements, transactions
from lakeshift.streaming.stream import Applier

CHANGE = f"id long, xid long, action string, nspname string, relname string, new {statements.PAIR}, old {statements.PAIR}"


def pairs(**values):
    return list(values.items())


def render(spark, rows, **more):
    df = spark.createDataFrame([(k, 1, a, "public", "t", n, o) for k, (a, n, o) in enumerate(rows)], CHANGE)
    return [(r.sql, r.args) for r in statements.statements(df, **more).orderBy("id").collect()]


def test_alike_neighbours_are_one_statement(spark):
    got = render(spark, [("I", pairs(id="1", v="a"), []), ("I", pairs(id="2", v=None), []), ("D", [], pairs(id="1")), ("D", [], pairs(id="2")), ("I", pairs(id="3"), [])])
    assert got == [
        ('INSERT INTO "public"."t" ("id", "v") overriding system value VALUES ($1, $2), ($3, $4)', ["1", "a", "2", None]),
        ('DELETE FROM "public"."t" WHERE "id" IN ($1, $2)', ["1", "2"]),
        ('INSERT INTO "public"."t" ("id") overriding system value VALUES ($1)', ["3"]),
    ]


def test_composite_deletes_and_nulls(spark):
    got = render(spark, [("D", [], pairs(a="1", b="2")), ("D", [], pairs(a="3", b="4")), ("D", [], pairs(a="5", b=None)), ("D", [], pairs(a="6", b=None))])
    assert [g[0] for g in got] == ['DELETE FROM "public"."t" WHERE ("a", "b") IN (($1, $2), ($3, $4))'] + ['DELETE FROM "public"."t" WHERE "a" = $1 and "b" IS NULL'] * 2


def test_updates_set_what_changes(spark):
    got = render(spark, [("U", pairs(id="1", v="b", w=None), pairs(id="1", v="a", w=None)), ("U", pairs(id="1"), pairs(id="1"))])
    assert got[0] == ('UPDATE "public"."t" SET "v" = $1 WHERE "id" = $2 and "v" = $3 and "w" IS NULL', ["b", "1", "a"])
    assert got[1] == (None, None)


def test_generated_columns(spark):
    g = spark.createDataFrame([("public", "t", ["g"])], "nspname string, relname string, attnames array<string>")
    got = render(spark, [("I", pairs(g="9", id="1"), []), ("U", pairs(id="1", v="x", g="5"), pairs(id="1"))], generated=g)
    assert got[0][0] == 'INSERT INTO "public"."t" ("id") overriding system value VALUES ($1)'
    assert got[1] == ('UPDATE "public"."t" SET "v" = $1, "g" = DEFAULT WHERE "id" = $2', ["x", "1"])


def test_parameters_are_bounded(spark):
    got = render(spark, [("I", pairs(a=str(k), b="x"), []) for k in range(5)], most=4)
    assert [len(a) for _, a in got] == [4, 4, 2]
    assert [s.count("(") for s, _ in got] == [3, 3, 2]


def test_dictionary(spark):
    df = spark.createDataFrame([(k, k, "I", "p", "t", pairs(a=str(k)), []) for k in range(4)], CHANGE)
    r = statements.statements(df)
    assert statements.dictionary(r).count() == 1 and statements.replayed(statements.facts(r), statements.dictionary(r)).count() == 4
    assert statements.as_script(r).first().script.startswith("PREPARE ")


@pytest.mark.parametrize(
    "message, want",
    [
        ("table public.t: INSERT: a[integer]:1 b[text]:'x''y'", ("I", "public", "t", None, [("N", "a", "t", "1"), ("N", "b", "t", "x'y")])),
        ('table "S .c"."t""x": DELETE: "a b"[text[]]:\'{1,2}\'', ("D", "S .c", 't"x', "K", [("K", "a b", "t", "{1,2}")])),
        ("table public.t: UPDATE: old-key: a[integer]:1 new-tuple: a[integer]:2 b[text]:unchanged-toast-datum c[text]:' new-tuple: '", ("U", "public", "t", "K", [("N", "a", "t", "2"), ("N", "b", "u", None), ("N", "c", "t", " new-tuple: "), ("K", "a", "t", "1")])),
        ("table public.t: INSERT: z[bit varying]:B'101' n[jsonb]:null", ("I", "public", "t", None, [("N", "z", "t", "101"), ("N", "n", "n", None)])),
        ("table public.t: TRUNCATE: (no-flags)", ("T", "public", "t", None, [])),
        ("table public.t: DELETE: (no-tuple-data)", ("D", "public", "t", None, [])),
        ('table public.r: INSERT: "time"[timestamp with time zone]:\'2017-07-15 02:54:30+00\' tags_id[integer]:48', ("I", "public", "r", None, [("N", "time", "t", "2017-07-15 02:54:30+00"), ("N", "tags_id", "t", "48")])),
    ],
)
def test_text_messages(message, want):
    a, n, r, o, c = decode.text_message(message)
    assert (a, n, r, o, [(x[0], *x[2:]) for x in c]) == want


@given(st.lists(st.tuples(st.text("ab \"[]:'.", min_size=1, max_size=6), st.one_of(st.none(), st.text("xy' \"\n:[]", max_size=8))), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_text_columns_round_trip(columns):
    ident = lambda n: '"' + n.replace('"', '""') + '"'
    value = lambda v: "null" if v is None else "'" + v.replace("'", "''") + "'"
    got = decode.text_columns(" ".join(f"{ident(n)}[text[]]:{value(v)}" for n, v in columns), "N")
    assert [(x[2], x[4]) for x in got] == columns


def test_json_keeps_digits(spark):
    m = {"action": "U", "xid": "5", "schema": "public", "table": "t", "columns": [{"name": "a", "type": "bigint", "value": 9007199254740993}, {"name": "b", "type": "boolean", "value": True}, {"name": "c", "type": "text", "value": None}], "identity": [{"name": "a", "type": "bigint", "value": 1}]}
    r = decode.from_json_messages(spark.createDataFrame([(1, 2, json.dumps(m)), (2, 3, '{"action":"Y","xid":"5"}')], "id long, lsn long, message string")).collect()
    assert len(r) == 1 and [(c.section, c.status, c.value) for c in r[0].cols] == [("N", "t", "9007199254740993"), ("N", "t", "true"), ("N", "n", None), ("O", "t", "1")]


def test_binary_messages():
    r = decode.BinaryReader()
    assert r.read(b"B" + struct.pack(">QQI", 77, 0, 9)) == [("B", 9, 77, None, None, None, [])]
    assert r.read(relation_message()) == []
    (got,) = r.read(binary_message("U", "5", "6", None))
    assert got[:6] == ("U", None, None, "public", "us ers", "K") and [c[:1] + c[2:] for c in got[6]] == [("N", "user_id", "t", "5"), ("N", "cents", "t", "6"), ("N", "props", "n", None), ("K", "user_id", "t", "5")]
    assert r.read(b"T" + struct.pack(">IBII", 2, 0, 7, 7)) == [("T", None, None, "public", "us ers", None, [])] * 2
    with_old = b"U" + struct.pack(">I", 7) + b"O" + struct.pack(">H", 3) + b"t\0\0\0\x011" + b"un" + b"N" + struct.pack(">H", 3) + b"t\0\0\0\x012" + b"uu"
    (got,) = r.read(with_old)
    assert got[5] == "O" and [c[3] for c in got[6]] == ["t", "u", "u", "t", "u", "n"]


def test_binary_messages_of_many_tasks(spark):
    truncate = b"T" + struct.pack(">IBII", 2, 0, 7, 8)
    rows = [(0, 5, 50, 1, binary_message("I", "1", "2", "x")), (0, 1, 10, 1, relation_message()), (0, 2, 10, 1, relation_message(8)), (0, 9, 90, 1, truncate), (0, 3, 30, 1, b"B" + struct.pack(">QQI", 77, 0, 9)), (1, 1, 10, 2, relation_message()), (1, 4, 40, 2, binary_message("D", "1", "2", None)), (0, 8, 80, 1, b"Y whatever")]
    df = spark.createDataFrame([(*r[:4], bytearray(r[4])) for r in rows], "stream long, id long, lsn long, xid long, message binary").repartition(3)
    got = sorted((r.id, r.action, r.lsn, r.xid, r.relname, len(r.cols)) for r in decode.from_binary_messages(df).collect())
    assert [g[:4] for g in got] == [(3, "B", 77, 9), (4, "D", 40, 2), (5, "I", 50, 1), (9, "T", 90, 1), (9, "T", 90, 1)] and got[2][5] == 3


def test_sent_columns(spark):
    rows = [([("K", 0, "a", "t", "1"), ("K", 1, "b", "n", None), ("N", 0, "a", "n", None), ("N", 1, "b", "u", None)],)]
    df = spark.createDataFrame(rows, f"cols array<{decode.COLUMN}>")
    r = df.select(decode.sent_columns(F.col("cols"), "K").alias("k"), decode.sent_columns(F.col("cols"), "N").alias("n")).first()
    assert [c.name for c in r.k] == ["a"] and [c.name for c in r.n] == ["a"]


def test_identity_of_updates(spark):
    m = spark.createDataFrame([(1, 1, 1, "table public.t: UPDATE: a[integer]:1 b[text]:'x'")], "id long, lsn long, xid long, message string")
    k = spark.createDataFrame([("public", "t", ["a"])], "nspname string, relname string, attnames array<string>")
    r = decode.with_identity(decode.from_text_messages(m), k).first()
    assert r.old_type == "K" and [(c.section, c.name) for c in r.cols] == [("N", "a"), ("N", "b"), ("K", "a")]


LOG = "id long, action string, xid long, lsn long, k long, v string"


def txn(xid, at, rows, end="C"):
    """BEGIN at a position, changes, and an end five later."""
    out = [(at * 10, "B", xid, at, None, None)] + [(at * 10 + n + 1, a, xid, at + n + 1, k, v) for n, (a, k, v) in enumerate(rows)]
    return out + ([(at * 10 + 50, end, xid, at + 5, None, None)] if end else [])


def test_redelivered_transactions(spark):
    first = txn(1, 10, [("I", 1, "old")], None)
    again = [(r[0] + 1000, *r[1:5], "new" if r[5] else None) for r in txn(1, 10, [("I", 1, "old")])]
    log = spark.createDataFrame(first + again, LOG)
    assert [r.v for r in transactions.in_commit_order(transactions.last_delivery(log)).collect()] == ["new"]
    t = transactions.transactions(log).first()
    assert (t.outcome, t.begin_id, t.n_dml) == ("commit", 1100, 1)


@pytest.mark.parametrize("begin, end, cursor, endpos, want", [(10, 15, 0, 0, "apply"), (10, 15, 15, 0, "skip"), (10, 15, 0, 9, "stop"), (10, 15, 0, 12, "apply and stop"), (10, None, 0, 12, "wait"), (10, 15, 0, 15, "apply"), (10, 15, 0, 10, "apply")])
def test_guards(spark, begin, end, cursor, endpos, want):
    lit = lambda x: F.lit(x).cast("long")
    assert spark.range(1).select(transactions.decision(lit(begin), lit(end), lit(cursor), lit(endpos))).first()[0] == want


def test_next_unit_keeps_shared_positions(spark):
    log = spark.createDataFrame(txn(1, 10, [("I", 1, "a")]) + [(151, "K", None, 15, None, None)] + txn(2, 15, [("I", 2, "b")]), LOG)
    assert transactions.next_unit(log, 15).first().xid == 2
    assert transactions.next_unit(log, 16).count() == 0
    assert transactions.next_unit(log, 11).first().action == "B"


def applied(spark, tmp_path, files, **more):
    a = Applier(spark, str(tmp_path / "state"), ["k"], ["v"], **more)
    for n, rows in enumerate(files):
        a.apply(spark.createDataFrame(rows, LOG), n)
    return a


def rows_of(a):
    return sorted((r.k, r.v) for r in a.state().collect())


def test_applier_waits_for_ends_and_repeats_nothing(spark, tmp_path):
    one, two = txn(1, 10, [("I", 1, "a"), ("I", 2, "b")]), txn(2, 20, [("U", 1, "c"), ("D", 2, None)])
    a = applied(spark, tmp_path, [one + two[:2]])
    assert rows_of(a) == [(1, "a"), (2, "b")] and a.cursor() == 15
    a.apply(spark.createDataFrame(two[2:], LOG), 1)
    assert rows_of(a) == [(1, "c")] and a.cursor() == 25
    a.apply(spark.createDataFrame(two[2:], LOG), 1)  # the batch is run again
    a.apply(spark.createDataFrame(one, LOG), 2)  # old transactions come again
    assert rows_of(a) == [(1, "c")] and a.cursor() == 25


def test_applier_goes_on_with_another_checkpoint(spark, tmp_path):
    """Positions decide, not numbers of batches: nothing is lost or applied twice, and old versions go."""
    put = lambda rows: spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    a = Applier(spark, str(tmp_path / "state"), ["k"], ["v"], buckets=2)
    run = lambda c: a.run(spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log")), str(tmp_path / c)).awaitTermination()
    for k in range(3):
        put(txn(k + 1, 10 * (k + 1), [("I", k, "a")]))
    run("one")
    assert rows_of(a) == [(0, "a"), (1, "a"), (2, "a")]
    put(txn(9, 90, [("U", 1, "b"), ("D", 2, None)]))
    run("two")
    assert rows_of(a) == [(0, "a"), (1, "b")] and a.cursor() > 90
    run("two")
    assert rows_of(a) == [(0, "a"), (1, "b")]
    assert len(a.versions()) == 2 and len(list((tmp_path / "state").glob("v=*"))) <= 4


def test_applier_ignores_rollbacks_and_truncates(spark, tmp_path):
    a = applied(spark, tmp_path, [txn(1, 10, [("I", 1, "a")]) + txn(2, 20, [("U", 1, "x")], "R"), txn(3, 30, [("T", None, None), ("I", 3, "z")])])
    assert rows_of(a) == [(3, "z")]


def test_end_position_within_a_transaction(spark, tmp_path):
    files = [txn(1, 10, [("I", 1, "a")]) + txn(2, 20, [("I", 2, "b")]), txn(3, 30, [("I", 3, "c")])]
    a = applied(spark, tmp_path, files, endpos=22)
    assert rows_of(a) == [(1, "a"), (2, "b")] and a.cursor() == 25


def test_segments(spark):
    log = spark.createDataFrame([(k, k // 4, 10) for k in range(40)], "lsn long, xid long, n long")
    s = state.segments(log, 100, F.col("n"))
    assert s.groupBy("xid").agg(F.count_distinct("segment_id").alias("n")).where("n > 1").count() == 0
    b = state.segment_bounds(s)
    assert b.where("endpos IS NULL").count() == 1
    assert state.segment_of(spark.createDataFrame([(39,), (0,), (99,)], "lsn long"), b).where("segment_id IS NULL").count() == 0
    assert state.prunable(b, 15).count() == 1
    assert state.timelines(spark.createDataFrame([(1, 100), (2, 200), (3, None)], "tli int, switch_lsn long")).where("tli = 2").first().begin_lsn == 100


def test_only_touched_buckets_are_written(spark, tmp_path):
    rows = [("I", k, "a") for k in range(40)]
    first = [(1, "B", 1, 10, None, None), *((2 + n, x, 1, 11 + n, k, v) for n, (x, k, v) in enumerate(rows)), (99, "C", 1, 99, None, None)]
    a = applied(spark, tmp_path, [first, txn(2, 200, [("U", 3, "b")]), txn(3, 300, [("D", 5, None)])])
    assert len(rows_of(a)) == 39 and (3, "b") in rows_of(a)
    note = a.note(2)
    assert len([v for v in note["buckets"].values() if v == 0]) >= len(note["buckets"]) - 2


def test_stream_of_the_log(spark, tmp_path):
    for n, rows in enumerate([txn(1, 10, [("I", 1, "a")]), txn(2, 20, [("I", 2, "b")])[:1], txn(2, 20, [("I", 2, "b")])[1:]]):
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    a = Applier(spark, str(tmp_path / "state"), ["k"], ["v"])
    a.run(stream, str(tmp_path / "c")).awaitTermination()
    assert rows_of(a) == [(1, "a"), (2, "b")]
    a.run(stream, str(tmp_path / "c")).awaitTermination()
    assert rows_of(a) == [(1, "a"), (2, "b")]


def test_following_to_an_end(spark, tmp_path):
    from lakeshift.streaming.follow import Control, follow

    control = Control(spark, str(tmp_path / "control"))
    control.set(startpos=1, endpos=0, apply=False)
    files, a, ended = [txn(1, 10, [("I", 1, "a")]), txn(2, 20, [("I", 2, "b")]), txn(3, 30, [("I", 3, "c")])], Applier(spark, str(tmp_path / "state"), ["k"], ["v"], buckets=4), []
    put = lambda rows: spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    run = lambda: follow(control, a, lambda: spark.readStream.schema(LOG).parquet(str(tmp_path / "log")), str(tmp_path / "c"), at_end=lambda: ended.append(1))
    put(files[0])
    assert run() == "waiting"
    control.set(apply=True)
    assert run() == "caught up" and control.get()["replay_lsn"] == 15
    control.set(endpos=22)
    put(files[1])
    put(files[2])
    assert run() == "done" and rows_of(a) == [(1, "a"), (2, "b")] and ended == [1]
    control.set(replay_lsn=3)
    assert control.get()["replay_lsn"] == 25


@pytest.mark.parametrize("seed", range(4))
def test_any_log_gives_what_its_changes_give_one_by_one(spark, tmp_path, seed):
    import random

    rng = random.Random(seed)
    log, state, at = [], {}, 10
    for xid in range(1, 9):
        rows = [(rng.choice("IIUUDT" if rng.random() < 0.2 else "IIUUD"), rng.randrange(6), f"{xid}.{n}") for n in range(rng.randrange(4))]
        rows = [(a, None if a == "T" else k, v if a in "IU" else None) for a, k, v in rows]
        end = rng.choice(["C", "C", "C", "R", None]) if xid < 8 else None
        log.append(txn(xid, at, rows, end))
        at += 10
        if end == "C":
            for a, k, v in rows:
                if a == "T":
                    state.clear()
                elif a == "D":
                    state.pop(k, None)
                else:
                    state[k] = v
    messages = [m for t in log for m in t]
    cut = sorted(rng.sample(range(len(messages)), 2))
    files = [messages[: cut[0]], messages[cut[0] : cut[1]], messages[cut[1] :] + rng.sample(messages, 3)]  # some come twice
    a = applied(spark, tmp_path, [f for f in files if f])
    assert rows_of(a) == sorted(state.items())


def test_the_stream_query_keeps_the_order_of_the_log(spark, tmp_path):
    """The log's first file takes the longest to write, so that it is the newest."""
    import random

    from lakeshift.plans.cdc_queries import cdc_apply_state, stream_cdc_apply

    rng = random.Random(0)
    kinds = ["signup", "view", "error", "click"]
    rows = [(k, k // 5, rng.choice(kinds), k / 100, f"{k}:{rng.randbytes(300_000).hex()}" if k < 80 else str(k)) for k in range(600)]
    schema = "event_id long, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "events.parquet"))
    got, want = (sorted(map(tuple, q(spark, str(tmp_path)).collect())) for q in (stream_cdc_apply, cdc_apply_state))
    assert got == want and len(want) > 5
    assert stream_cdc_apply(spark, str(tmp_path / "none")).count() == 0
