import corpus_pipeline as p
from lakeshift.llm import line_dedup, quality, simhash

from .test_decontamination import brute as leaks
from .test_line_dedup import brute as lines
from .test_packing import check
from .test_simhash import roots, slow


def test_stages_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = docs
    for n, (name, stage) in enumerate(p.STAGES):
        before = [(r.doc_id, r.text) for r in out.collect()]
        out = stage(spark, out, sf).cache()
        if n < 4:
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        after = {r.doc_id: r for r in out.collect()} if n < 4 else None
        if name == "quality_classifier":
            kept = {r.doc_id for r in quality.op4_quality(spark, sf).collect() if r.predicted}
            assert set(after) == kept
        elif name == "line_dedup":
            import hashlib

            want = {d: h for d, _, _, h in lines(before)}
            assert {d: hashlib.sha256(r.text.encode()).hexdigest() for d, r in after.items()} == want
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "simhash_near_dedup":
            before.sort()
            r = roots([slow(t) for _, t in before])
            assert set(after) == {before[k][0] for k in set(r)}
        elif name == "benchmark_decontamination":
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert set(after) == {d for d, _ in before} - {d for d, _ in leaks(before, bench)}
        else:
            check(out.collect(), before)


def test_run_is_its_stages(spark, sf):
    out = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in p.STAGES:
        out = stage(spark, out, sf)
    assert sorted(map(tuple, p.run(spark, sf).collect())) == sorted(map(tuple, out.collect()))
    assert p.ORACLE_SQL is None and len(p.STAGES) == 5


def test_odd_rows(spark, docs_of):
    sf = "/root/testdata/sf0.001"
    rows = [(1, None), (2, ""), (2, ""), (3, "one two three"), (None, "some text"), (4, "a text of some length " * 30)]
    for docs in (docs_of(rows), docs_of([])):
        for name, stage in p.STAGES:
            docs = stage(spark, docs, sf)
            assert docs.count() >= 0, name
    _ = line_dedup, simhash
