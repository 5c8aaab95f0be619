"""Queries of change streams over a log that is made from the events.

Event e is change e + 1 at position 10 (e + 1) of transaction e div 7 + 1. Transactions commit 5 after their last
change, where the next one begins; every thirteenth is rolled back, the last has no end. Signups insert, errors delete,
the others update, all in the relation public.users of key user_id.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.plans.frames import shared_path, spread, table
from lakeshift.plans.registry import query
from lakeshift.streaming import apply, decode, state, statements, transactions
from lakeshift.streaming.stream import Applier

LOG_SQL = """dml AS (SELECT event_id, (event_id + 1) * 10 AS lsn, event_id // 7 + 1 AS xid, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS action, user_id, CAST(round(value * 100) AS BIGINT) AS cents, props FROM events),
txn AS (SELECT xid, min(lsn) - 5 AS first, max(lsn) + 5 AS last, xid = (SELECT max(xid) FROM dml) AS is_last FROM dml GROUP BY xid),
log AS (
  SELECT lsn * 4 + 3 AS id, action, xid, lsn, user_id, cents, props FROM dml
  UNION ALL SELECT first * 4 + 2, 'B', xid, first, NULL, NULL, NULL FROM txn
  UNION ALL SELECT last * 4, CASE WHEN xid % 13 = 0 THEN 'R' ELSE 'C' END, xid, last, NULL, NULL, NULL FROM txn WHERE NOT is_last
  UNION ALL SELECT last * 4 + 1, 'K', NULL, last, NULL, NULL, NULL FROM txn WHERE xid % 10 = 0 AND NOT is_last)"""


def changes(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    action = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    lsn = (F.col("event_id") + 1) * 10
    return e.select((lsn * 4 + 3).alias("id"), action.alias("action"), (F.floor(F.col("event_id") / 7) + 1).cast("long").alias("xid"), lsn.alias("lsn"), "user_id", F.round(F.col("value") * 100).cast("long").alias("cents"), "props")


def log(spark, sf_dir) -> DataFrame:
    d = changes(spark, sf_dir)
    t = d.groupBy("xid").agg((F.min("lsn") - 5).alias("first"), (F.max("lsn") + 5).alias("last"))
    t = t.crossJoin(d.agg(F.max("xid").alias("max_xid"))).withColumn("is_last", F.col("xid") == F.col("max_xid"))  # one row
    no = [F.lit(None).cast(k).alias(c) for c, k in (("user_id", "long"), ("cents", "long"), ("props", "string"))]
    begin = t.select((F.col("first") * 4 + 2).alias("id"), F.lit("B").alias("action"), "xid", F.col("first").alias("lsn"), *no)
    ended = t.where("NOT is_last")
    end = ended.select((F.col("last") * 4).alias("id"), F.when(F.col("xid") % 13 == 0, "R").otherwise("C").alias("action"), "xid", F.col("last").alias("lsn"), *no)
    alive = ended.where("xid % 10 = 0").select((F.col("last") * 4 + 1).alias("id"), F.lit("K").alias("action"), F.lit(None).cast("long").alias("xid"), F.col("last").alias("lsn"), *no)
    return d.unionByName(begin).unionByName(end).unionByName(alive)


_AGAIN = """again AS (SELECT * FROM log UNION ALL SELECT id + 1000000000, action, xid, lsn, user_id, cents + 1, props FROM log WHERE xid % 5 = 0 AND action <> 'K')"""


def delivered_again(spark, sf_dir) -> DataFrame:
    x = log(spark, sf_dir)
    return x.unionByName(x.where("xid % 5 = 0 AND action <> 'K'").withColumn("id", F.col("id") + 1_000_000_000).withColumn("cents", F.col("cents") + 1))


@query(f"WITH {LOG_SQL}, {_AGAIN} SELECT id, action, xid, lsn, user_id, cents, props FROM (SELECT *, row_number() OVER (PARTITION BY action, lsn ORDER BY id DESC) AS k FROM again) WHERE k = 1")
def cdc_dedup_last_delivery(spark, sf_dir) -> DataFrame:
    return transactions.last_delivery(delivered_again(spark, sf_dir))


_TXN = """b AS (SELECT xid, max(id) AS begin_id, arg_max(lsn, id) AS begin_lsn FROM log WHERE action = 'B' GROUP BY xid),
t AS (SELECT b.xid, b.begin_id, b.begin_lsn, min(l.id) FILTER (WHERE l.action IN ('C', 'R')) AS end_id, min(l.lsn) FILTER (WHERE l.action IN ('C', 'R')) AS end_lsn, coalesce(min(CASE l.action WHEN 'C' THEN 'commit' WHEN 'R' THEN 'rollback' END), 'open') AS outcome, count(*) FILTER (WHERE l.action IN ('I', 'U', 'D', 'T')) AS n_dml
  FROM b LEFT JOIN log l ON l.xid = b.xid AND l.id > b.begin_id GROUP BY ALL)"""


@query(f"WITH {LOG_SQL}, {_TXN} SELECT xid, begin_id, begin_lsn, end_id, end_lsn, outcome, n_dml FROM t")
def cdc_transactions(spark, sf_dir) -> DataFrame:
    return transactions.transactions(log(spark, sf_dir))


@query(f"WITH {LOG_SQL}, {_TXN} SELECT l.id, l.action, l.xid, l.lsn, l.user_id, l.cents FROM log l JOIN t ON l.xid = t.xid WHERE t.outcome <> 'open' AND l.id BETWEEN t.begin_id AND t.end_id")
def cdc_complete_txns_only(spark, sf_dir) -> DataFrame:
    return transactions.complete(log(spark, sf_dir)).select("id", "action", "xid", "lsn", "user_id", "cents")


_SPARSE = "sparse AS (SELECT * FROM log WHERE action <> 'U')"


@query(f"WITH {LOG_SQL}, {_SPARSE} SELECT id, action, xid, lsn FROM sparse WHERE action NOT IN ('B', 'C', 'R') OR xid IN (SELECT xid FROM sparse WHERE action IN ('I', 'D')) OR xid = (SELECT max(xid) FROM log)")
def cdc_empty_txn_elision(spark, sf_dir) -> DataFrame:
    """A log without updates: transactions of updates alone are empty, and vanish if they have ended."""
    return transactions.without_empty(log(spark, sf_dir).where("action <> 'U'")).select("id", "action", "xid", "lsn")


_CURSORS = (0, 5, 75, 705, 706, 1405, 99_999_999)


@query(f"WITH {LOG_SQL} " + " UNION ALL ".join(f"(SELECT CAST({c} AS BIGINT) AS after, id, action, xid, lsn FROM log WHERE (action = 'B' AND lsn >= {c}) OR (action IN ('K', 'X') AND lsn > {c}) ORDER BY lsn, CASE WHEN action = 'B' THEN 0 ELSE 1 END, id LIMIT 1)" for c in _CURSORS))
def cdc_next_unit_cursor(spark, sf_dir) -> DataFrame:
    x = log(spark, sf_dir)
    found = [transactions.next_unit(x, c).select(F.lit(c).cast("long").alias("after"), "id", "action", "xid", "lsn") for c in _CURSORS]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


@query(f"""WITH {LOG_SQL}, {_TXN}, e AS (SELECT * FROM (VALUES (0, 0), (700, 0), (700, 1403), (0, 705), (75, 20)) v(replay, endpos))
SELECT xid, CAST(replay AS BIGINT) AS replay, CAST(endpos AS BIGINT) AS endpos, CASE WHEN end_lsn IS NULL THEN 'wait' WHEN end_lsn <= replay THEN 'skip' WHEN endpos <> 0 AND endpos < begin_lsn THEN 'stop' WHEN endpos <> 0 AND begin_lsn < endpos AND endpos < end_lsn THEN 'apply and stop' ELSE 'apply' END AS decision FROM t, e""")
def cdc_endpos_guards(spark, sf_dir) -> DataFrame:
    t = transactions.transactions(log(spark, sf_dir))
    e = F.explode(F.array(*[F.struct(F.lit(a).cast("long").alias("replay"), F.lit(b).cast("long").alias("endpos")) for a, b in ((0, 0), (700, 0), (700, 1403), (0, 705), (75, 20))]))
    return t.withColumn("e", e).select("xid", "e.replay", "e.endpos", transactions.decision(F.col("begin_lsn"), F.col("end_lsn"), F.col("e.replay"), F.col("e.endpos")).alias("decision"))


@query(f"""WITH {LOG_SQL}, c AS (SELECT * FROM log WHERE action IN ('I', 'U', 'D')),
f AS (SELECT *, CASE WHEN lag(action) OVER w = action AND lag(user_id % 2) OVER w = user_id % 2 THEN 0 ELSE 1 END AS new FROM c WINDOW w AS (PARTITION BY xid ORDER BY id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY xid ORDER BY id) AS run FROM f),
p AS (SELECT *, (row_number() OVER (PARTITION BY xid, run ORDER BY id) - 1) // 2 AS part FROM r)
SELECT xid, action, min(id) AS first_id, count(*) AS n_rows FROM p GROUP BY xid, action, run, part""")
def cdc_coalesce_islands(spark, sf_dir) -> DataFrame:
    """Runs of at most two rows: five parameters are allowed, and each row has two."""
    c = changes(spark, sf_dir).withColumn("odd", F.col("user_id") % 2)
    x = transactions.with_run(c, ["action", "odd"], ["id"], 5, F.lit(2))
    return x.groupBy("xid", "action", "run").agg(F.min("id").alias("first_id"), F.count("*").alias("n_rows")).drop("run")


@query(f"""WITH {LOG_SQL}, u AS (SELECT id, user_id, cents % 3 AS a, props, lag(cents % 3) OVER w AS old_a, lag(props) OVER w AS old_props, row_number() OVER w AS n FROM log WHERE action = 'U' WINDOW w AS (PARTITION BY user_id ORDER BY id))
SELECT id, user_id, concat_ws(',', CASE WHEN n = 1 OR a IS DISTINCT FROM old_a THEN 'a' END, CASE WHEN n = 1 OR props IS DISTINCT FROM old_props THEN 'props' END) AS set_columns FROM u""")
def cdc_update_set_pruning(spark, sf_dir) -> DataFrame:
    from pyspark.sql.window import Window

    w = Window.partitionBy("user_id").orderBy("id")
    u = changes(spark, sf_dir).where("action = 'U'").withColumn("a", (F.col("cents") % 3).cast("string"))
    pair = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    new = F.array(pair("a", F.col("a")), pair("props", F.col("props")))
    old = F.when(F.row_number().over(w) == 1, F.array().cast(statements.PAIR)).otherwise(F.array(pair("a", F.lag("a").over(w)), pair("props", F.lag("props").over(w))))
    return u.select("id", "user_id", new.alias("new"), old.alias("old")).select("id", "user_id", F.array_join(F.transform(statements.pruned(F.col("new"), F.col("old")), lambda c: c["name"]), ",").alias("set_columns"))


_STATE = """o AS (SELECT user_id, lsn AS pos, action, cents, CASE WHEN cents % 2 = 0 THEN props END AS p, cents % 2 <> 0 AS u FROM c WHERE action <> 'T'),
g AS (SELECT user_id, greatest(coalesce(max(pos) FILTER (WHERE action = 'D'), -1), (SELECT coalesce(max(lsn), -1) FROM c WHERE action = 'T')) AS gone, max(pos) FILTER (WHERE action IN ('I', 'U')) AS put FROM o GROUP BY user_id)
SELECT o.user_id, arg_max(cents, pos) AS cents, arg_max(p, pos) FILTER (WHERE NOT u) AS props FROM o JOIN g ON o.user_id = g.user_id WHERE g.put > g.gone AND o.pos > g.gone AND o.action IN ('I', 'U') GROUP BY o.user_id"""


def _with_truncate(df: DataFrame, at: int) -> DataFrame:
    return df.withColumn("action", F.when(F.col("lsn") == at, "T").otherwise(F.col("action")))


@query(f"WITH {LOG_SQL}, {_TXN}, c AS (SELECT l.* FROM log l JOIN t ON l.xid = t.xid WHERE t.outcome = 'commit' AND l.action IN ('I', 'U', 'D')), {_STATE}")
def cdc_apply_state(spark, sf_dir) -> DataFrame:
    """The rows that are there after all committed transactions; props is unchanged where cents are odd."""
    c = transactions.in_commit_order(log(spark, sf_dir)).withColumn("u", F.col("cents") % 2 != 0)
    return apply.fold(c, ["user_id"], ["cents", "props"], ["commit_lsn", "id"], {"props": F.col("u")}, apply.last_truncation(c, ["commit_lsn", "id"]))


@query(f"WITH {LOG_SQL}, {_TXN}, c AS (SELECT l.id, CASE WHEN l.lsn = 5000 THEN 'T' ELSE l.action END AS action, l.xid, l.lsn, l.user_id, l.cents, l.props FROM log l JOIN t ON l.xid = t.xid WHERE t.outcome = 'commit' AND l.action IN ('I', 'U', 'D')), {_STATE}")
def cdc_apply_truncate(spark, sf_dir) -> DataFrame:
    c = _with_truncate(transactions.in_commit_order(log(spark, sf_dir)), 5000).withColumn("u", F.col("cents") % 2 != 0)
    return apply.fold(c, ["user_id"], ["cents", "props"], ["commit_lsn", "id"], {"props": F.col("u")}, apply.last_truncation(c, ["commit_lsn", "id"]))


@query(f"""WITH {LOG_SQL}, {_TXN}, c AS (SELECT l.* FROM log l JOIN t ON l.xid = t.xid WHERE t.outcome = 'commit' AND l.action IN ('I', 'U', 'D')), {_STATE}""")
def cdc_apply_incremental(spark, sf_dir) -> DataFrame:
    """The same state in two steps: that of the first half is merged with the second half's changes."""
    c = transactions.in_commit_order(log(spark, sf_dir)).withColumn("u", F.col("cents") % 2 != 0)
    half = c.agg((F.floor(F.max("commit_lsn") / 2)).cast("long").alias("h"))
    x = c.crossJoin(half)  # one row
    first, rest = x.where("commit_lsn <= h").drop("h"), x.where("commit_lsn > h").drop("h")
    before = apply.fold(first, ["user_id"], ["cents", "props"], ["commit_lsn", "id"], {"props": F.col("u")})
    return apply.merged(before, rest, ["user_id"], ["cents", "props"], ["commit_lsn", "id"], {"props": F.col("u")})


@query(f"""WITH {LOG_SQL}, u AS (SELECT user_id, CASE WHEN cents % 4 = 0 THEN cents END AS a, CASE WHEN cents % 5 = 0 THEN props END AS b, lsn FROM log WHERE action IN ('I', 'U'))
SELECT user_id, arg_max(a, lsn) FILTER (WHERE a IS NOT NULL) AS cents, arg_max(b, lsn) FILTER (WHERE b IS NOT NULL) AS props FROM u GROUP BY user_id""")
def cdc_unchanged_fold(spark, sf_dir) -> DataFrame:
    """Unchanged columns keep the last value that was sent."""
    c = changes(spark, sf_dir).where("action <> 'D'")
    return apply.fold(c, ["user_id"], ["cents", "props"], ["lsn"], {"cents": F.col("cents") % 4 != 0, "props": F.col("cents") % 5 != 0})


@query(f"""WITH {LOG_SQL}, m AS (SELECT lsn, action, user_id, action = 'U' AND cents % 4 = 0 AS moves, cents FROM log WHERE action IN ('I', 'U', 'D')),
x AS (SELECT lsn * 2 AS pos, 'D' AS action, user_id + 1 AS user_id, cents FROM m WHERE moves UNION ALL SELECT lsn * 2 + CAST(moves AS INT), CASE WHEN moves THEN 'I' ELSE action END, user_id, cents FROM m)
SELECT user_id, arg_max(cents, pos) FILTER (WHERE action <> 'D') AS cents FROM x GROUP BY user_id HAVING max(pos) FILTER (WHERE action <> 'D') > coalesce(max(pos) FILTER (WHERE action = 'D'), -1)""")
def cdc_key_change(spark, sf_dir) -> DataFrame:
    """Updates that change the key (here: from the next one, where cents divide by 4) delete the old one."""
    moves = (F.col("action") == "U") & (F.col("cents") % 4 == 0)
    c = changes(spark, sf_dir).withColumn("old_id", F.when(moves, F.col("user_id") + 1).otherwise(F.col("user_id")))
    return apply.fold(apply.with_moved_keys(c, ["user_id"], ["old_id"]), ["user_id"], ["cents"], ["lsn", "step"])


def pairs(c: DataFrame) -> DataFrame:
    """Changes with name and value pairs; the key is (user_id), and every ninth cents is null."""
    pair = lambda n, v: F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"))
    cents = F.when(F.col("cents") % 9 != 0, F.col("cents"))
    none = F.array().cast(statements.PAIR)
    new = F.array(pair("user_id", F.col("user_id")), pair("cents", cents), pair("p q", F.col("props")))
    old = F.array(pair("user_id", F.col("user_id")), pair("cents", F.when(F.col("user_id") % 2 == 0, F.col("cents") % 2)))
    return c.select("id", "xid", "action", F.lit("public").alias("nspname"), F.lit("users").alias("relname"), F.when(F.col("action") == "D", none).otherwise(new).alias("new"), F.when(F.col("action") == "I", none).when(F.col("action") == "D", F.array(pair("user_id", F.col("user_id")))).otherwise(old).alias("old"))


_RENDER = f"""WITH {LOG_SQL}, c AS (SELECT * FROM log WHERE action IN ('I', 'U', 'D')),
f AS (SELECT *, CASE WHEN lag(action) OVER w = action AND action <> 'U' THEN 0 ELSE 1 END AS new FROM c WINDOW w AS (PARTITION BY xid ORDER BY id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY xid ORDER BY id) AS run FROM f),
n AS (SELECT xid, run, action, min(id) AS id, count(*) AS n_rows, any_value(user_id) AS user_id, any_value(cents) AS cents FROM r GROUP BY xid, run, action),
s AS (SELECT xid, id, action, n_rows, CASE action
  WHEN 'I' THEN 'INSERT INTO "public"."users" ("user_id", "cents", "p q") overriding system value VALUES ' || list_aggregate([ '($' || CAST(3 * k + 1 AS VARCHAR) || ', $' || CAST(3 * k + 2 AS VARCHAR) || ', $' || CAST(3 * k + 3 AS VARCHAR) || ')' FOR k IN range(n_rows)], 'string_agg', ', ')
  WHEN 'D' THEN CASE WHEN n_rows = 1 THEN 'DELETE FROM "public"."users" WHERE "user_id" = $1' ELSE 'DELETE FROM "public"."users" WHERE "user_id" IN (' || list_aggregate(['$' || CAST(k + 1 AS VARCHAR) FOR k IN range(n_rows)], 'string_agg', ', ') || ')' END
  ELSE 'UPDATE "public"."users" SET ' || CASE WHEN (CASE WHEN cents % 9 <> 0 THEN cents END) IS DISTINCT FROM (CASE WHEN user_id % 2 = 0 THEN cents % 2 END) THEN '"cents" = $1, "p q" = $2 WHERE "user_id" = $3 and "cents"' || CASE WHEN user_id % 2 = 0 THEN ' = $4' ELSE ' IS NULL' END ELSE '"p q" = $1 WHERE "user_id" = $2 and "cents"' || CASE WHEN user_id % 2 = 0 THEN ' = $3' ELSE ' IS NULL' END END END AS sql FROM n)"""


@query(f"{_RENDER} SELECT xid, id, action, n_rows, sql FROM s")
def cdc_render_statements(spark, sf_dir) -> DataFrame:
    return statements.statements(pairs(changes(spark, sf_dir))).select("xid", "id", "action", "n_rows", "sql")


@query(f"{_RENDER} SELECT sql, count(*) AS n FROM s GROUP BY sql")
def cdc_statement_dictionary(spark, sf_dir) -> DataFrame:
    r = statements.statements(pairs(changes(spark, sf_dir)))
    x = statements.facts(r).join(statements.dictionary(r), "hash")
    return x.groupBy("sql").agg(F.count("*").alias("n"))


_DECODED = f"WITH {LOG_SQL} SELECT id, lsn, xid, action, 'public' AS nspname, 'us ers' AS relname, CAST(user_id AS VARCHAR) AS user_id, CASE WHEN action <> 'D' THEN CAST(cents AS VARCHAR) END AS cents, CASE WHEN action <> 'D' AND cents % 3 <> 0 THEN props || '''q' END AS props FROM log WHERE action IN ('I', 'U', 'D')"


def _flat(decoded: DataFrame) -> DataFrame:
    """Decoded changes with their columns side by side: those of the new tuple, or of the old key where there is none."""

    def value(name: str, section: str | None = None):
        mine = lambda c: (c["name"] == name) & (c["section"] == section) if section else c["name"] == name
        return F.try_element_at(F.transform(F.filter("cols", mine), lambda c: c["value"]), F.lit(1)).alias(name)

    return decoded.select("id", "lsn", "xid", "action", "nspname", "relname", value("user_id"), value("cents", "N"), value("props", "N"))


def _props():
    return F.when(F.col("cents") % 3 != 0, F.concat("props", F.lit("'q")))


@query(_DECODED)
def cdc_json_decode(spark, sf_dir) -> DataFrame:
    """JSON messages rendered from the events, decoded again."""
    c = spread(changes(spark, sf_dir))
    col = lambda n, t, v: F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), v.alias("value"))
    new = F.array(col("user_id", "bigint", F.col("user_id").cast("string")), col("cents", "bigint", F.col("cents").cast("string")), col("props", "text", _props()))
    old = F.array(col("user_id", "bigint", F.col("user_id").cast("string")))
    body = F.struct(F.col("action"), F.col("xid").cast("string").alias("xid"), F.lit("public").alias("schema"), F.lit("us ers").alias("table"), F.when(F.col("action") != "D", new).alias("columns"), F.when(F.col("action") != "I", old).alias("identity"))
    return _flat(decode.from_json_messages(c.select("id", "lsn", F.to_json(body).alias("message"))))


@query(_DECODED)
def cdc_text_decode(spark, sf_dir) -> DataFrame:
    """Textual messages with quoted values rendered from the events, decoded again."""
    c = spread(changes(spark, sf_dir))
    quoted = F.coalesce(F.concat(F.lit("'"), F.replace(_props(), F.lit("'"), F.lit("''")), F.lit("'")), F.lit("null"))
    key = F.concat(F.lit("user_id[bigint]:"), F.col("user_id").cast("string"))
    new = F.concat(key, F.lit(" cents[numeric(20,0)]:"), F.col("cents").cast("string"), F.lit(" props[text[]]:"), quoted)
    head = F.concat(F.lit('table public."us ers": '), F.when(F.col("action") == "I", "INSERT").when(F.col("action") == "U", "UPDATE").otherwise("DELETE"), F.lit(": "))
    body = F.when(F.col("action") == "D", key).when((F.col("action") == "U") & (F.col("cents") % 2 == 0), F.concat(F.lit("old-key: "), key, F.lit(" new-tuple: "), new)).otherwise(new)
    return _flat(decode.from_text_messages(c.select("id", "lsn", "xid", F.concat(head, body).alias("message"))))


def binary_message(action: str, user_id: str, cents: str, props: str | None, oid: int = 7) -> bytes:
    """A change in the binary format."""
    text = lambda v: b"n" if v is None else b"t" + struct.pack(">I", len(v.encode())) + v.encode()
    key = struct.pack(">H", 3) + text(user_id) + b"n" + b"n"
    new = struct.pack(">H", 3) + text(user_id) + text(cents) + text(props)
    return action.encode() + struct.pack(">I", oid) + (b"K" + key if action == "D" else b"N" + new)


def relation_message(oid: int = 7) -> bytes:
    column = lambda n, key: struct.pack(">B", key) + n.encode() + b"\0" + struct.pack(">Ii", 25, -1)
    return b"R" + struct.pack(">I", oid) + b"public\0us ers\0" + b"d" + struct.pack(">H", 3) + column("user_id", 1) + column("cents", 0) + column("props", 0)


@query(_DECODED)
def cdc_binary_decode(spark, sf_dir) -> DataFrame:
    """Binary messages rendered from the events in eight streams, each with its relation, decoded again."""
    c = spread(changes(spark, sf_dir)).select("id", "lsn", "xid", (F.col("xid") % 8).alias("stream"), "action", F.col("user_id").cast("string").alias("u"), F.col("cents").cast("string").alias("c"), _props().alias("p"))

    def encode(batches):
        for b in batches:
            yield pd.DataFrame({"stream": b["stream"], "id": b["id"], "lsn": b["lsn"], "xid": b["xid"], "message": [binary_message(a, u, c, p) for a, u, c, p in zip(b["action"], b["u"], b["c"], b["p"], strict=True)]})

    head = spark.createDataFrame([(s, -1, 0, 0, bytearray(relation_message())) for s in range(8)], "stream long, id long, lsn long, xid long, message binary")
    return _flat(decode.from_binary_messages(head.unionByName(c.mapInPandas(encode, head.schema))))


@query(f"""WITH {LOG_SQL}, c AS (SELECT * FROM log WHERE action IN ('I', 'U', 'D'))
SELECT id AS output_id, 'N' AS section, CAST(0 AS INT) AS pos, 'user_id' AS name, 't' AS status, CAST(user_id AS VARCHAR) AS value FROM c WHERE action <> 'D'
UNION ALL SELECT id, 'N', 1, 'cents', 't', CAST(cents AS VARCHAR) FROM c WHERE action <> 'D'
UNION ALL SELECT id, 'O', 0, 'user_id', 't', CAST(user_id AS VARCHAR) FROM c WHERE action <> 'I'""")
def cdc_column_rows(spark, sf_dir) -> DataFrame:
    c = changes(spark, sf_dir)
    col = lambda n, v: F.struct(F.lit(n).alias("name"), F.lit("bigint").alias("type"), v.cast("string").alias("value"))
    body = F.struct(F.col("action"), F.col("xid").cast("string").alias("xid"), F.lit("public").alias("schema"), F.lit("users").alias("table"), F.when(F.col("action") != "D", F.array(col("user_id", F.col("user_id")), col("cents", F.col("cents")))).alias("columns"), F.when(F.col("action") != "I", F.array(col("user_id", F.col("user_id")))).alias("identity"))
    return decode.exploded(decode.from_json_messages(c.select("id", "lsn", F.to_json(body).alias("message"))))


_SEG = """c AS (SELECT lsn, xid, length(props) AS n FROM log WHERE action IN ('I', 'U', 'D')), t AS (SELECT xid, min(lsn) AS first, sum(n) AS n FROM c GROUP BY xid),
seg AS (SELECT xid, CAST(coalesce(sum(n) OVER (ORDER BY first, xid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 2000 AS BIGINT) AS segment_id FROM t),
l AS (SELECT segment_id, min(lsn) AS startpos, max(lsn) AS last FROM c JOIN seg USING (xid) GROUP BY segment_id),
bounds AS (SELECT segment_id, startpos, CASE WHEN lead(segment_id) OVER (ORDER BY segment_id) IS NOT NULL THEN last END AS endpos FROM l)"""


def bounds(spark, sf_dir) -> DataFrame:
    return state.segment_bounds(state.segments(changes(spark, sf_dir), 2000, F.length("props")))


@query(f"WITH {LOG_SQL}, {_SEG} SELECT segment_id, startpos, endpos FROM bounds")
def cdc_segments(spark, sf_dir) -> DataFrame:
    return bounds(spark, sf_dir)


@query(f"WITH {LOG_SQL}, {_SEG}, p AS (SELECT lsn + 3 AS lsn FROM dml) SELECT p.lsn, min(segment_id) AS segment_id FROM p LEFT JOIN bounds ON p.lsn >= startpos AND (endpos IS NULL OR p.lsn <= endpos) GROUP BY p.lsn")
def cdc_segment_lookup(spark, sf_dir) -> DataFrame:
    p = changes(spark, sf_dir).select((F.col("lsn") + 3).alias("lsn"))
    return state.segment_of(p, bounds(spark, sf_dir))


@query(f"WITH {LOG_SQL}, {_SEG} SELECT segment_id, CASE WHEN endpos IS NOT NULL THEN lead(segment_id) OVER (ORDER BY segment_id) END AS next_id FROM bounds")
def cdc_segment_successor(spark, sf_dir) -> DataFrame:
    return state.successors(bounds(spark, sf_dir))


@query(f"WITH {LOG_SQL}, {_SEG} SELECT segment_id, startpos, endpos FROM bounds WHERE endpos < 20000")
def cdc_prunable_segments(spark, sf_dir) -> DataFrame:
    return state.prunable(bounds(spark, sf_dir), 20000)


@query("""SELECT arg_max(CASE WHEN event_type = 'signup' THEN event_id END, CASE WHEN event_type = 'signup' THEN event_id END) AS startpos, max(CASE WHEN event_type = 'error' THEN event_id END) AS endpos, arg_max(user_id % 2 = 0, event_id) AS apply, max(CAST(round(value) AS BIGINT)) AS write_lsn, max(user_id) AS flush_lsn, coalesce(max(CASE WHEN user_id = 1 THEN event_id END), 0) AS replay_lsn FROM events""")
def cdc_sentinel_merge(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    of = lambda t: F.when(F.col("event_type") == t, F.col("event_id"))
    return state.sentinel(e.select(F.col("event_id").alias("seq"), of("signup").alias("startpos"), of("error").alias("endpos"), (F.col("user_id") % 2 == 0).alias("apply"), F.round("value").cast("long").alias("write_lsn"), F.col("user_id").alias("flush_lsn"), F.when(F.col("user_id") == 1, F.col("event_id")).alias("replay_lsn")))


@query("""WITH e AS (SELECT 'p' || CAST(user_id % 4 AS VARCHAR) AS process, event_id AS seq, CASE event_type WHEN 'signup' THEN 'start' WHEN 'error' THEN 'end' WHEN 'view' THEN 'txn_begin' WHEN 'click' THEN 'txn_done' ELSE 'sync' END AS event, event_id % 3 <> 0 AS ok, event_id // 7 AS xid, event_id * 2 AS lsn FROM events),
g AS (SELECT process, max(seq) FILTER (WHERE event = 'start') AS s, max(seq) FILTER (WHERE event = 'end') AS x, arg_max(ok, seq) FILTER (WHERE event = 'end') AS ok, max(seq) FILTER (WHERE event = 'txn_begin') AS b, max(seq) FILTER (WHERE event = 'txn_done') AS d, arg_max(xid, seq) FILTER (WHERE event = 'txn_begin') AS xid, arg_max(lsn, seq) AS lsn FROM e GROUP BY process)
SELECT process, CASE WHEN x > s THEN CASE WHEN ok THEN 'done' ELSE 'error' END ELSE 'running' END AS status, CASE WHEN b > coalesce(d, -1) THEN xid END AS pending_xid, lsn FROM g""")
def cdc_pipeline_runs(spark, sf_dir) -> DataFrame:
    t = F.col("event_type")
    event = F.when(t == "signup", "start").when(t == "error", "end").when(t == "view", "txn_begin").when(t == "click", "txn_done").otherwise("sync")
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("p"), (F.col("user_id") % 4).cast("string")).alias("process"), F.col("event_id").alias("seq"), event.alias("event"), (F.col("event_id") % 3 != 0).alias("ok"), F.floor(F.col("event_id") / 7).cast("long").alias("xid"), (F.col("event_id") * 2).alias("lsn"))
    return state.runs(e)


@query(f"WITH {LOG_SQL} SELECT id, action, xid FROM log WHERE xid IS NULL OR xid NOT IN (SELECT xid FROM log WHERE action = 'R')")
def cdc_delete_by_xid(spark, sf_dir) -> DataFrame:
    x = log(spark, sf_dir)
    return transactions.without_transactions(x, x.where("action = 'R'").select("xid")).select("id", "action", "xid")


@query(f"WITH {LOG_SQL} SELECT DISTINCT xid, 'public' AS nspname, 'mv' || CAST(user_id % 3 AS VARCHAR) AS relname FROM log WHERE action IN ('I', 'U', 'D') AND user_id % 3 < 2")
def cdc_matview_refresh(spark, sf_dir) -> DataFrame:
    c = changes(spark, sf_dir).withColumn("nspname", F.lit("public")).withColumn("relname", F.concat(F.lit("mv"), (F.col("user_id") % 3).cast("string")))
    return apply.refreshes(c, spark.createDataFrame([("public", "mv0"), ("public", "mv1")], "nspname string, relname string"))


@query(f"WITH {LOG_SQL}, {_TXN}, c AS (SELECT l.* FROM log l JOIN t ON l.xid = t.xid WHERE t.outcome = 'commit' AND l.action IN ('I', 'U', 'D')), {_STATE}")
def stream_cdc_apply(spark, sf_dir) -> DataFrame:
    """The state that a stream of the log in several files leaves, applied batch by batch."""
    path = shared_path(spark, "stream")
    x = log(spark, sf_dir).withColumn("u", F.col("cents") % 2 != 0)
    x.repartitionByRange(6, "id").sortWithinPartitions("id").write.parquet(f"{path}/whole")
    whole = spark.read.schema(x.schema).parquet(f"{path}/whole")
    lo, hi = whole.agg(F.coalesce(F.min("id"), F.lit(0)), F.coalesce(F.max("id"), F.lit(0))).first()
    step = (hi - lo) // 3 + 1
    applier = Applier(spark, f"{path}/state", ["user_id"], ["cents", "props"], {"props": F.col("u")}, buckets=8)
    applier.run_segments((whole.where((F.col("id") >= a) & (F.col("id") < a + step)) for a in range(lo, lo + 3 * step, step)), f"{path}/log", f"{path}/checkpoint")
    return applier.state()
