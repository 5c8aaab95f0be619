import hashlib
from collections import defaultdict

from lakeshift.llm import line_dedup as d


def brute(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(lower)
    low = lambda i: -(2**63) if i is None else i
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders[key(x)].add(low(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        drop = [len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and low(i) < max(holders[key(x)]) for x in lines]
        kept = "\n".join(x for x, n in zip(lines, drop, strict=True) if not n)
        out.append((i, len(lines), sum(drop), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(docs):
    from pyspark.sql import functions as F

    x = d.dedup_lines(docs).select("doc_id", "_n_lines", "_n_dropped", F.sha2("_kept_text", 256), "_keep_bitmap")
    return [tuple(r) for r in x.collect()]


LINE, OTHER = "this line is in very many documents", "É another line that is found thrice"


def test_cases(docs_of):
    rows = [(1, f"{LINE}\nown\n{LINE}\n{OTHER}"), (2, f"  {LINE.upper()}\t\n{OTHER}"), (3, f"{LINE}\r\n{OTHER}"), (4, f"{LINE}\n{LINE}"), (5, "short\nshort"), (6, "short"), (7, "short"), (None, LINE), (9, None), (10, ""), (1, f"{LINE}\nown\n{LINE}\n{OTHER}"), (11, OTHER.lower())]
    x = got(docs_of(rows))
    assert sorted((r[:4] for r in x), key=repr) == brute(rows)
    assert {r[4] for r in x if r[0] == 1} == {"0+1,2+2"} and {r[4] for r in x if r[0] == 4} == {""}


def test_hot_lines(docs_of):
    rows = [(k, f"{LINE}\nunique line number {k} of some length\n{OTHER if k % 2 else ''}") for k in range(400)]
    assert sorted((r[:4] for r in got(docs_of(rows))), key=repr) == brute(rows)


def test_limits_of_hot_lines_change_nothing(docs_of):
    """Lines in nine tenths of the documents, with more of them than are broadcast."""
    from pyspark.sql import functions as F

    rows = [(k, f"{LINE}\nunique line number {k} of some length\n{OTHER if k % 10 else ''}\nshared by few of them {k % 40}") for k in range(200)]
    for limits in ({"most_rows": 5, "most_hot": 0}, {"most_rows": 5}, {}):
        x = d.dedup_lines(docs_of(rows), **limits).select("doc_id", "_n_lines", "_n_dropped", F.sha2("_kept_text", 256))
        assert sorted(map(tuple, x.collect()), key=repr) == brute(rows)


def test_odd_rows(odd_docs, docs_of, spark, sf):
    assert sorted((r[:4] for r in got(odd_docs)), key=repr) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert got(docs_of([])) == []
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted((r[:4] for r in got(docs)), key=repr) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_no_python_in_the_plan(spark, sf):
    plan = d.op3_line_dedup(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
