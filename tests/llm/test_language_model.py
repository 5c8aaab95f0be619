import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lakeshift.llm import language_model as m


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def brute(rows, held):
    """Interpolated counts of words, pairs and trigrams; failures: arcs of a state that don't exist."""
    uni, bi, tri = Counter(), Counter(), Counter()
    for (d, t), h in zip(rows, held, strict=True):
        if not h:
            w = ["start", *tokens(t)]
            uni.update(w)
            bi.update(zip(w, w[1:], strict=False))
            tri.update(zip(w, w[1:], w[2:], strict=False))
    starts = uni.pop("start", 0)
    n, z = sum(uni.values()), sum(uni.values()) + 0.5 * (len(uni) + 1)
    one = lambda u: starts if u == "start" else uni[u]
    out = []
    for (d, t), h in zip(rows, held, strict=True):
        w = ["start", *tokens(t)]
        base, score, fails = [], [], 0
        for k in range(1, len(w)):
            u, v, x = (w[k - 2] if k > 1 else None), w[k - 1], w[k]
            base.append((uni[x] + 0.5) / z)
            p = (bi[v, x] + m.PRIOR * base[-1]) / (one(v) + m.PRIOR)
            fails += one(v) > 0 and not bi[v, x]
            if u is not None:
                p = (tri[u, v, x] + m.PRIOR * p) / (bi[u, v] + m.PRIOR)
                fails += bi[u, v] > 0 and not tri[u, v, x]
            score.append(p)
        out.append((d, h, len(w) - 1, sum(uni[x] > 0 for x in w[1:]), n, sum(map(math.log10, base)), sum(map(math.log10, score)), fails))
    return out


def close(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 4))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:7] for r in got], [r[5:7] for r in want], rtol=1e-9, atol=1e-9)
    assert [r[7] for r in got] == [r[7] for r in want]


def folds(rows):
    return [zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1 for d, _ in rows]


def test_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = [tuple(r) for r in m.op2_backoff(spark, sf).collect()]
    close(got, brute(rows, folds(rows)))
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_small_blocks_and_odd_rows(odd_docs, docs_of):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = m.lm_scores(odd_docs, m.fold() == 1, block_bytes=50_000, bucket_bytes=20_000)
    close([tuple(r) for r in got.collect()], brute(rows, folds(rows)))
    assert m.lm_scores(docs_of([]), m.fold() == 1).count() == 0
    only = m.lm_scores(docs_of([(1, "a b")]), F.lit(True)).first()
    assert (only.n_known, only.train_tokens) == (0, 0) and math.isclose(only.score, only.base_score) and math.isclose(only.base_score, 0.0)


def test_states_are_distributions(docs_of):
    """The probabilities of all words and one unknown sum to 1 after each word."""
    train = [(k, t) for k, t in enumerate(["a b a c", "b b a", "c"] * 2)]
    vocabulary = ["a", "b", "c", "zzz"]
    probe = [(1000 + k, f"{u} {w}") for k, (u, w) in enumerate((u, w) for u in vocabulary for w in vocabulary)]
    alone = [(2000 + k, u) for k, u in enumerate(vocabulary)]
    got = {r.doc_id: r.score for r in m.lm_scores(docs_of(train + probe + alone), F.col("doc_id") >= 1000).collect()}
    # P(w after u) = P(u w end) / (P(u) P(end after w)); P(end after w) is had from "w": P(w end) / P(w)
    data = brute(train + probe + alone, [d >= 1000 for d, _ in train + probe + alone])
    assert all(math.isclose(got[r[0]], r[6]) for r in data)


def test_packing():
    x = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype("u8"))
    assert (m.unpacked(m.packed(x), "<u8") == x).all() and len(m.unpacked(m.packed(x[:0]), "<u8")) == 0
    table = m.table_of(m.parts_of(x, np.ones(len(x), "i8"), 7, 40), m.PARTS)
    assert (np.concatenate(m.hashes_in(table)) == x).all() and table["bucket"].to_pylist() == sorted(set(m.range_of(x, 40).tolist()))


def test_two_steps_of_exchange_give_the_same(spark, sf):
    """Many blocks and more buckets than a task sends to."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    key = lambda r: tuple(r)
    one = sorted(m.lm_scores(docs, m.fold() == 1).collect(), key=key)
    two = sorted(m.lm_scores(docs, m.fold() == 1, block_bytes=20_000, bucket_bytes=10_000, fan=7).collect(), key=key)
    assert len(one) == len(two) and all(a[:5] == b[:5] and a[7] == b[7] and np.allclose(a[5:7], b[5:7], rtol=1e-12) for a, b in zip(one, two, strict=True))


def test_packets_grow_with_the_data():
    """Blocks of 3000 hashes: what a task sends is in proportion to its data, whatever the number of blocks and buckets."""
    rng, fan = np.random.default_rng(2), 32
    for blocks, buckets in ((32, 1000), (1000, 1000)):
        first = [len(m.parts_of(np.sort(rng.integers(0, 2**64, 3000, "u8")), np.ones(3000, "i8"), k, min(buckets, fan))) for k in range(blocks)]
        assert sum(first) <= blocks * fan
        # a range of `fan` blocks goes on to the buckets of the range alone
        group = np.unique(rng.integers(0, 2**59, 3000 // fan * fan, "u8"))
        assert len(m.parts_of(group, np.ones(len(group), "i8"), 0, buckets)) <= buckets // fan + 1


def test_lanes_do_not_matter(spark, docs_of, monkeypatch):
    rows = [(k, " ".join(f"w{(k * j * j) % 7}" for j in range(k % 40))) for k in range(120)]
    got = []
    for lanes in (1, 5, 10**6):
        monkeypatch.setattr(m, "LANES", lanes)
        docs = pa.table({"doc_id": [d for d, _ in rows], "held_out": [d % 5 == 1 for d, _ in rows], "n": [len(t) for _, t in rows], "text": [m._ZIP.compress(t.encode()) for _, t in rows], "block": [0] * len(rows)})
        block = m.Block(docs)
        hashes, counts, at, _ = block.trigrams(np.zeros(len(block.hashes), bool))
        counts[hashes == 0] = 0
        got.append(m.walk(block, block.counts.astype("u8"), counts.astype("u8")[at], int(block.taught.sum()), 8, 60.0))
    assert all(np.allclose(a, b, rtol=1e-12) for other in got[1:] for a, b in zip(got[0], other, strict=True))


def test_one_key_holds_most_rows(docs_of):
    rows = [(None, f"a b c {k % 9}") for k in range(900)] + [(k, "a b d") for k in range(100)]
    got = m.lm_scores(docs_of(rows), m.fold() == 1, block_bytes=500, bucket_bytes=1000, fan=3)
    close([tuple(r) for r in got.collect()], brute(rows, folds(rows)))
