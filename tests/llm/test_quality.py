import zlib

import numpy as np

from lakeshift.llm import quality as q


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = q.op4_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) > 0.95


def test_bag_and_scores_agree():
    rng = np.random.default_rng(2)
    table = rng.normal(size=q.BUCKETS).astype("f4")
    parts = q.Parts(table)
    for text in ("a b b c", "Über der die die", "x"):
        ids, w = q.bag(text)
        words = text.encode().split()
        want = (sum(parts[x] for x in words) + q.repeats(words) * parts.table[q.REPEAT]) / (len(words) + q.repeats(words))
        assert abs(float(w @ table[ids]) - want) < 1e-4 and abs(w.sum() - 1) < 1e-5
    assert q.bag("")[1].sum() == 0


def test_odd_rows(odd_docs, docs_of, spark):
    labels = spark.createDataFrame([(4, 1), (6, 0), (None, 1), (8, None), (99, 0), (5, 1)], "doc_id long, quality int")
    model = q.fit(odd_docs, labels)
    rows = q.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and set(rows[0].asDict()) == {*odd_docs.columns, "_score"} and all(0 <= r._score <= 1 for r in rows)
    assert q.score(docs_of([]), model).count() == 0
    nothing = q.fit(odd_docs, labels.limit(0))
    assert {r._score for r in q.score(odd_docs, nothing).collect()} == {0.5}
    assert q.score(odd_docs, q.fit(odd_docs, labels.where("quality = 1"))).first()._score > 0.99


def test_bounded_sample(docs_of, spark):
    docs = docs_of([(k, f"word{k}") for k in range(50)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)], "doc_id long, quality int")
    assert q.fit(docs, labels, most=10)[0].shape == (q.BUCKETS,)
