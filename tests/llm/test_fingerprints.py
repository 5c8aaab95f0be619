import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeshift.llm import fingerprints as f


def slow(data):
    """Closed syncmers one k-mer at a time."""
    h = [int(f.mixed(np.array([int.from_bytes(data[k : k + f.S], "little")], "u8"))[0]) for k in range(len(data) - f.S + 1)]
    out = []
    for k in range(len(data) - f.K + 1):
        own = h[k : k + f.K - f.S + 1]
        if min(own) in (own[0], own[-1]):
            out.append(k)
    return out


@given(st.binary(min_size=16, max_size=300))
@settings(max_examples=60, deadline=None)
def test_syncmers(data):
    assert f.syncmers(data)[1].tolist() == slow(data)


def test_unchanged_passages_keep_their_anchors():
    a, b = bytes(range(97, 123)) * 3 + b"0123456789" * 9, b"something else before it: "
    inner = {int(h) for h in f.syncmers(a)[0]}
    assert inner <= {int(h) for h in f.syncmers(b + a + b)[0]}


def brute(rows):
    key = lambda r: (-(r[0] if r[0] is not None else -(2**63)), r[1] or "")
    rows = sorted(rows, key=key)
    out = []
    for k, (d, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        e = t[: len(t) - len(t) // 3] + n[: len(t) // 3]
        a, b, c = (f.sketch(x.encode()) for x in (t, e, n))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), f.rendered(a), f.rendered(b), f.likeness(a, b), f.likeness(a, c)))
    return out


def test_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, f.op1_syncmers(spark, sf).collect())) == sorted(want)
    small = f.fingerprints(docs.where("doc_id < 40"), bucket_rows=3)
    assert sorted(map(tuple, small.collect())) == sorted(brute([(r.doc_id, r.text) for r in docs.where("doc_id < 40").collect()]))


def test_odd_rows(odd_docs, docs_of):
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert sorted(map(repr, map(tuple, f.fingerprints(odd_docs, bucket_rows=2).collect()))) == sorted(map(repr, want))
    assert f.fingerprints(docs_of([])).count() == 0
    (one,) = f.fingerprints(docs_of([(1, "abcdef")])).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1


def test_likeness_tells_edits_from_others(spark, sf):
    rows = [r for r in f.op1_syncmers(spark, sf).collect() if r.n_chars > 300]
    assert np.mean([r.near_edited for r in rows]) > 0.55 and np.mean([r.near_next for r in rows]) < 0.05
