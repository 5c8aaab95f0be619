import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeshift.llm import substring_dedup as s


def tree(x, lo, hi, span):
    """Compact windows by recursion at the first least value."""
    if hi - lo < span:
        return []
    c = lo + int(np.argmin(x[lo:hi]))
    return [(lo, c, hi - 1), *tree(x, lo, c, span), *tree(x, c + 1, hi, span)]


@given(st.lists(st.integers(0, 2**40), min_size=1, max_size=120), st.integers(2, 12))
@settings(max_examples=150, deadline=None)
def test_compact_windows(values, span):
    x = np.array(values, "u8")
    assert sorted(s.compact_windows(x, span)) == sorted(tree(x, 0, len(x), span))


def words(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n)]


def spans(rows):
    return {r.doc_id: [(p.start, p.end) for p in r.passages] for r in rows}


def test_planted_passages(docs_of):
    rng = random.Random(3)
    p1, p2 = words(rng, 60), words(rng, 80)
    changed = p2.copy()
    changed[40] = "another"
    missing = p2[:50] + p2[51:]
    docs = {1: words(rng, 100) + p1 + words(rng, 30), 2: p1 + words(rng, 200), 3: words(rng, 90), 4: words(rng, 40) + p2, 5: words(rng, 10) + changed + words(rng, 70), 6: missing + words(rng, 55), 7: words(rng, 20) + p1[:40] + words(rng, 90), 8: words(rng, 70)}
    docs[9] = docs[8]
    got = s.repeated_passages(docs_of([(d, " ".join(w)) for d, w in docs.items()])).collect()
    cls = {r.doc_id: r.class_id for r in got}
    assert cls == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 4, 7: 7, 8: 8, 9: 8}
    at = spans(got)
    near = lambda x, y: len(x) == 1 and abs(x[0][0] - y[0]) <= 6 and abs(x[0][1] - y[1]) <= 6
    assert near(at[1], (100, 160)) and near(at[2], (0, 60)) and at[3] == [] and at[7] == [] and at[9] == [(0, 70)] and near(at[4], (40, 120))


def test_common_lines_alone_link_nothing(docs_of):
    rng = random.Random(5)
    line, p = words(rng, 12), words(rng, 60)
    docs = {k: words(rng, 60) + line + (p if k in (17, 150, 151) else words(rng, 60)) for k in range(200)}
    rows = s.repeated_passages(docs_of([(d, " ".join(w)) for d, w in docs.items()])).collect()
    assert {r.doc_id: r.class_id for r in rows if r.passages} == {17: 17, 150: 17, 151: 17}
    assert all(r.class_id == r.doc_id for r in rows if not r.passages)


def brute(rows, n=50):
    seen = defaultdict(set)
    for d, t in rows:
        w = (t or "").encode().lower().split()
        for k in range(len(w) - n + 1):
            seen[tuple(w[k : k + n])].add(d)
    return {frozenset(v) for v in seen.values() if len(v) > 1}


def test_nothing_is_missed(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r for r in s.op5_passages(spark, sf).collect()}
    assert len(got) == len(rows)
    for group in brute(rows):
        assert len({got[d].class_id for d in group}) == 1 and all(got[d].passages for d in group)
    flagged = [d for d in got if got[d].passages]
    assert len(flagged) < 0.3 * len(rows)


def test_split_groups(docs_of):
    rng = random.Random(4)
    p = words(rng, 70)
    docs = docs_of([(k, " ".join(words(rng, 30) + p + words(rng, 30))) for k in range(60)])
    rows = s.repeated_passages(docs, held=7).collect()
    assert {r.class_id for r in rows} == {0}
    # bytes of shingles beyond the passage agree by chance now and then
    assert all(len(x) == 1 and 22 <= x[0][0] <= 30 and 100 <= x[0][1] <= 108 for x in spans(rows).values())


def windows_of(rows):
    """A table of windows of one key, as surroundings() makes it."""
    import pyarrow as pa

    n = len(rows)
    return pa.table({"key": pa.array([7] * n, pa.int64()), "text": pa.array(range(n), pa.int64()), "at": pa.array([100] * n, pa.int64()), "n": pa.array([n] * n, pa.int64()), "around": pa.array([r.astype("u1").tobytes() for r in rows], pa.binary()), "more": pa.array([None] * n, pa.binary())})


def link_sets(rows):
    up = list(range(len(rows)))
    for a, b in zip(*(s.linked(windows_of(rows))[c].to_pylist() for c in ("text_a", "text_b")), strict=True):
        up = [up[a] if k == up[b] else k for k in up]
    return {frozenset(k for k in range(len(rows)) if up[k] == c) for c in up}


@given(st.integers(0, 2**32), st.sampled_from([-2, -1, 1, 2]), st.sampled_from([-1, 1]))
@settings(max_examples=25, deadline=None)
def test_shifted_copies_meet_in_large_groups(seed, shift, side):
    rng = np.random.default_rng(seed)
    near, width = rng.integers(1, 256, (2, 2 * s.SPAN - 1)), 2 * s.SPAN - 1
    # a word more or less some shingles from the middle: what lies beyond is shifted
    cut = s.SPAN - 1 + side * 6
    near[1] = np.where((np.arange(width) - cut) * side >= 0, np.roll(near[0], shift), near[0])
    near[1, cut] = rng.integers(1, 256)
    far = s.SPAN - 1 - side * 10
    keep = (np.arange(width) - far) * side > 0
    near[1, ~keep] = rng.integers(1, 256, int((~keep).sum()))
    others = rng.integers(1, 256, (s.MANY + 60, width))
    few, many = link_sets([others[0], *near, *others[1:20]]), link_sets([others[0], *near, *others[1:]])
    assert frozenset((1, 2)) in few and len(few) == 21
    assert frozenset((1, 2)) in many and len(many) == len(others) + 1


def test_families_of_split_groups_meet(docs_of):
    rng = random.Random(8)
    keys = lambda w: {int(h[p]) for h in [s.shingle_hashes(" ".join(w))[0]] for p in s.window_places(h).tolist()}
    # a line whose middle shingles have the least hashes by all functions, and sides that don't have less
    long = words(rng, 200_000)
    h, _ = s.shingle_hashes(" ".join(long))
    low = np.ones(len(h) - 2, bool)
    for k in range(s.FUNCTIONS):
        y = (h ^ np.uint64(0x632BE59BD9B4E019 * (k + 1) & (2**64 - 1))) * s.M2
        y ^= y >> np.uint64(31)
        low &= s.sliding_least(y * s.M1, 3) < np.uint64(2**64 // 40)
    at = int(np.flatnonzero(low[10:])[0]) + 10
    line = long[at - 3 : at + 10]
    own = set(s.shingle_hashes(" ".join(line))[0].tolist())
    shared = lambda left, right: keys((left or words(rng, 44)) + line + (right or words(rng, 44))) & keys((left or words(rng, 44)) + line + (right or words(rng, 44)))
    left = next(w for w in (words(rng, 40) for _ in range(2000)) if shared(w, None) and shared(w, None) <= own)
    rights = [next(w for w in (words(rng, 40) for _ in range(2000)) if shared(None, w) and shared(None, w) <= own) for _ in range(8)]
    docs = {k: left + line + words(rng, 44) for k in range(40)} | {40 + k: words(rng, 44) + line + w for k, w in enumerate(rights)} | {50 + k: left + line + w for k, w in enumerate(rights)}
    rows = s.repeated_passages(docs_of([(d, " ".join(w)) for d, w in docs.items()]), held=7).collect()
    assert {r.class_id for r in rows} == {0}


def test_odd_rows(odd_docs, docs_of):
    rows = s.repeated_passages(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.class_id for r in rows if r.doc_id in (6, 7)} == {6} and all(r.class_id == r.doc_id for r in rows if r.doc_id not in (6, 7))
    assert s.repeated_passages(docs_of([])).count() == 0
    rows = s.repeated_passages(docs_of([(1, "x " * 500), (2, "x " * 700 + "y"), (3, None)])).collect()
    at = spans(rows)
    assert at[1] == [(0, 500)] and at[2] in ([(0, 700)], [(0, 701)]) and at[3] == [] and {r.doc_id: r.class_id for r in rows} == {1: 1, 2: 1, 3: 3}


def covered(rows, n=50):
    """Words of each document in exact passages of n words that another text has."""
    seen, out = defaultdict(set), defaultdict(set)
    texts = [(d, (t or "").encode().lower().split(), t) for d, t in rows]
    for _, w, t in texts:
        for k in range(len(w) - n + 1):
            seen[tuple(w[k : k + n])].add(t)
    for d, w, _ in texts:
        for k in range(len(w) - n + 1):
            if len(seen[tuple(w[k : k + n])]) > 1:
                out[d].update(range(k, k + n))
    return out


def test_all_words_of_exact_passages_are_covered(docs_of):
    """Also where three texts share parts of each other, and where words and phrases repeat."""
    rng = random.Random(11)
    base, phrase = words(rng, 200), words(rng, 3)
    texts = [base, words(rng, 20) + base[40:150] + words(rng, 20), words(rng, 9) + base[70:190], base[60:125] + words(rng, 60), words(rng, 30) + base[10:75]]
    texts += [phrase * 30 + base[:70], words(rng, 5) + phrase * 40 + words(rng, 5), phrase * 25 + words(rng, 40)]
    rows = [(k, " ".join(w)) for k, w in enumerate(texts)]
    for more in ({}, {"held": 2}, {"local": 1}):
        got = spans(s.repeated_passages(docs_of(rows), **more).collect())
        for d, places in covered(rows).items():
            assert places <= {p for a, b in got[d] for p in range(a, b)}


def test_ways_of_windows_give_the_same(docs_of):
    """Frequent keys sent by units, and packets in two steps, against the plain way."""
    rng = random.Random(12)
    line, p, q = words(rng, 55), words(rng, 60), words(rng, 70)
    texts = [words(rng, 30) + line + words(rng, 30) for _ in range(60)] + [words(rng, 20) + p for _ in range(3)] + [q + words(rng, 9) for _ in range(2)] + [words(rng, 80) for _ in range(30)]
    docs = docs_of([(k, " ".join(w)) for k, w in enumerate([*texts, texts[0], texts[70]])])
    row = lambda r: (r.doc_id, r.class_id, r.n_copies, tuple(map(tuple, r.passages)))
    plain = sorted(map(row, s.repeated_passages(docs).collect()))
    assert {c for _, c, _, p in plain if p} == {0, 60, 63, 70}
    for more in ({"local": 3}, {"local": 2, "unit_bytes": 3000, "bucket_bytes": 2000}, {"fan": 3, "unit_bytes": 5000, "bucket_bytes": 1000}):
        got = sorted(map(row, s.repeated_passages(docs, **more).collect()))
        assert [r[:3] for r in got] == [r[:3] for r in plain]
        assert all(abs(a[0] - b[0]) <= 2 and abs(a[1] - b[1]) <= 2 for x, y in zip(got, plain, strict=True) for a, b in zip(x[3], y[3], strict=True))


@given(st.integers(0, 2**32))
@settings(max_examples=6, deadline=None)
def test_group_sizes_on_both_sides_of_the_limit(seed):
    """The same related windows among 20 to 3000 others are linked the same."""
    rng = np.random.default_rng(seed)
    width = 2 * s.SPAN - 1
    kin = np.repeat(rng.integers(1, 256, (4, width)), 3, axis=0)
    for r in kin:
        r[rng.integers(0, width, 3)] = rng.integers(1, 256, 3)
        if rng.random() < 0.5:
            cut = s.SPAN + int(rng.integers(3, 30))
            r[cut:] = np.roll(r, int(rng.choice([-1, 1])))[cut:]
    related = None
    for n in (20, s.MANY - 2, s.MANY + 2, 300, 3000):
        rows = np.concatenate([rng.integers(1, 256, (1, width)), kin, rng.integers(1, 256, (n, width))])
        got = {g for g in link_sets(rows) if len(g) > 1 and max(g) <= len(kin)}
        related = got if related is None else related
        assert got == related


def runs(rng, n):
    """Windows in runs of a few shingles, as texts of words that come again and again have them: most pairs share bytes, and few agree."""
    width, middle = 2 * s.SPAN - 1, s.SPAN - 1
    out = rng.integers(1, 256, (n, width))
    for r in out:
        r[middle - int(rng.integers(0, 14)) : middle + int(rng.integers(24, 27))] = 168
    return out


def test_windows_of_runs_are_compared_a_few_times_at_most(monkeypatch):
    rng, n, pairs = np.random.default_rng(3), 600, [0]
    agreeing = s.agreeing

    def counted(a, b):
        pairs[0] += max(len(a), len(b))
        return agreeing(a, b)

    monkeypatch.setattr(s, "agreeing", counted)
    rows = runs(rng, n)
    got = link_sets(rows)
    # every two windows once either way round, and some for spans; link_sets() asks twice
    assert pairs[0] <= 2 * (n * n + 50 * n)
    for a in range(0, n, 7):
        ok = agreeing(rows[a].astype("u1")[None, :], rows.astype("u1"))[0]
        own = next(g for g in got if a in g)
        assert set(np.flatnonzero(ok).tolist()) <= own


def test_the_order_of_windows_does_not_matter():
    """A pair that only agrees one way round, as where places shift, is linked either way."""
    rng, width, found = np.random.default_rng(5), 2 * s.SPAN - 1, 0
    for _ in range(4000):
        a = rng.integers(1, 256, width)
        b = np.roll(a, int(rng.choice([-2, -1, 1, 2])))
        lo, hi = int(rng.integers(10, 42)), int(rng.integers(50, 82))
        b[:lo], b[hi:] = rng.integers(1, 256, lo), rng.integers(1, 256, width - hi)
        x, y = a.astype("u1")[None, :], b.astype("u1")[None, :]
        if s.agreeing(x, y)[0][0] != s.agreeing(y, x)[0][0]:
            found += 1
            assert link_sets([a, b]) == link_sets([b, a]) == {frozenset((0, 1))}
    assert found
