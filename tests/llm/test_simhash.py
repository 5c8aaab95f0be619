import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeshift.llm import simhash as s


def slow(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def roots(fps, bits=3):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


@given(st.lists(st.sampled_from(["a", "B", "b", "é", "x.y"]), max_size=12))
@settings(max_examples=80, deadline=None)
def test_fingerprint(words):
    assert s.fingerprint("  ".join(words)) == slow("  ".join(words))


def test_long_texts_take_the_other_way():
    text = " ".join(f"w{k % 331}" for k in range(2000))
    assert s.fingerprint(text) == slow(text)


def test_any_three_positions_miss_a_set():
    from itertools import combinations

    assert len(s.POSITIONS) == 14 and all(any(not set(p) & set(c) for p in s.POSITIONS) for c in combinations(range(8), 3))


def dense(seed, n, flips=4):
    """Fingerprints around a few centres, and others."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randrange(flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x if rng.random() < 0.8 else rng.getrandbits(64))
    return sorted(out)


def components_of(spark, fps, **parameters):
    from lakeshift.llm.common import components

    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x, k) for k, x in enumerate(fps)], "fp long, rep long")
    found = components(s.near_links(nodes, **parameters))
    x = nodes.join(found, nodes.fp == found.node, "left").selectExpr("rep", "coalesce(component, fp) AS c").collect()
    least = {}
    for r in x:
        least[r.c] = min(least.get(r.c, r.rep), r.rep)
    return [least[c] for _, c in sorted((r.rep, r.c) for r in x)]


def test_links_by_pairs_by_forests_and_by_split_lists(spark):
    fps = dense(1, 300)
    want = roots(fps)
    assert components_of(spark, fps) == want
    assert components_of(spark, fps, pairwise=5) == want
    assert components_of(spark, fps, pairwise=2, longest=10) == want


def test_lists_are_split_to_the_end(spark):
    """Fingerprints that share five bytes: only the half bytes of the others tell them apart."""
    rng = random.Random(3)
    top = rng.getrandbits(40) << 24
    fps = sorted({top | (rng.choice([0x123456, 0xABCDEF, rng.getrandbits(24)]) ^ (1 << rng.randrange(24)) ^ (1 << rng.randrange(24))) for _ in range(250)})
    assert components_of(spark, fps, pairwise=2, longest=10) == roots(fps) == components_of(spark, fps)


def test_rows_of_hot_fingerprints(docs_of, monkeypatch):
    monkeypatch.setattr(s, "HOT_ROWS", 20)
    rows = [(k, "") for k in range(300)] + [(300 + k, f"some words of text number {k} that differ much {k * 7919} {k * 104729}") for k in range(30)]
    got = s.near_duplicates(docs_of(rows)).collect()
    assert len(got) == 330 and {r.component for r in got if r.id < 300} == {0} and all(r.component is not None for r in got)


def test_forest_is_whole():
    fps = dense(2, 200)
    links = s.forest(np.array(fps, "u8"), 3, block=7)
    parent = roots(fps)
    assert len(links) == len(fps) - len(set(parent)) and all(parent[a] == parent[b] for a, b in links)


def test_against_brute_force(spark, sf):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    fps = [slow(t) for _, t in rows]
    want = {(rows[k][0], f"{fps[k]:016x}", rows[c][0]) for k, c in enumerate(roots(fps))}
    assert {tuple(r) for r in s.op8_simhash(spark, sf).collect()} == want


def test_odd_rows(odd_docs, docs_of):
    rows = s.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.root, set()).add(r.component)
    assert all(len(c) == 1 for c in by.values())
    assert {r.component for r in rows if r.id in (1, 2, 3)} == {1} and {r.component for r in rows if r.id in (6, 7)} == {6}
    assert s.near_duplicates(docs_of([])).count() == 0


def test_one_of_each(odd_docs, docs_of):
    kept = s.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 4, 5, 6, 8, 8, None], key=repr)
    far = docs_of([(None, "aa bb cc dd"), (None, "ee ff gg hh"), (None, "aa bb cc dd")])
    assert s.one_of_each(far).count() == 2 and s.one_of_each(docs_of([])).count() == 0
