import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeshift.llm import packing as p


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 4), max_size=8), st.integers(0, 90))
@settings(max_examples=200, deadline=None)
def test_fullest(lengths, room):
    flat = [x for x, n in lengths.items() for _ in range(n)]
    sums = {0}
    for x in flat:
        sums |= {a + x for a in sums if a + x <= room}
    got = p.fullest(lengths, room)
    assert sum(x * n for x, n in got.items()) == max(sums) and all(n <= lengths[x] for x, n in got.items())


@given(st.lists(st.integers(1, 100), max_size=60))
@settings(max_examples=60, deadline=None)
def test_pack_lengths(lengths):
    windows = p.pack_lengths(lengths, 100)
    assert sorted(k for w in windows for k in w) == list(range(len(lengths))) and all(sum(lengths[k] for k in w) <= 100 for w in windows)


@given(st.text(st.sampled_from("abCD'sStTrREeVvMmLlDd09.,!?<|>éÉßẞÀÿ×÷ªµ́ \n\t\x0b\x1c\x85 ΣσςİıñÑ日😀"), max_size=30))
@settings(max_examples=300, deadline=None)
def test_tokenizer_is_the_librarys(text):
    t = p.tokenizer_of(p.default_tokenizer())
    for x in (text, text + "<|endoftext|>", "it's " + text.upper()):
        assert t(x) == np.array(t.tokenizer.encode(x, add_special_tokens=False).ids, dtype="<u4").tobytes()


def check(rows, docs, window=4096):
    """Pieces tile each document, sequences are gapless, and each piece's checksum is right."""
    library = p.WholeTokenizer(p.default_tokenizer())
    known = {x: library(x or "") for _, x in docs}
    t = lambda x: known.get(x) or library(x)
    want = sorted(len(t(x or "")) // 4 + 1 for _, x in docs)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert sum(r.length for r in rows) == sum(want)
    for own in by_seq.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist() and sum(r.length for r in own) <= window
    ids = {d: t(x or "") + (2).to_bytes(4, "little") for d, x in docs}
    for d, x in docs:
        if sum(1 for e, _ in docs if e == d) == 1:
            own = sorted(by_doc[d], key=lambda r: r.start)
            assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist()
            assert all(zlib.crc32(ids[d][4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32 and r.doc_tokens == len(ids[d]) // 4 for r in own)
    return by_seq


def test_packs_all(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    by_seq = check(p.op6_pack(spark, sf).collect(), docs)
    totals = [sum(r.length for r in own) for own in by_seq.values()]
    assert sum(4096 - n for n in totals if n & (n - 1)) < 0.01 * sum(totals)


def test_odd_rows(odd_docs, docs_of):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(p.pack(odd_docs, p.default_tokenizer()).collect(), docs)
    check(p.pack(odd_docs, p.default_tokenizer(), block_rows=3).collect(), docs)
    assert p.pack(docs_of([]), p.default_tokenizer()).count() == 0


def test_equal_rows_are_spread(docs_of):
    """Nine tenths of the rows are equal, or have one id: no block gets them all."""
    for hot in ([(None, "the same text of some words")] * 900, [(7, "w " * (k % 50)) for k in range(900)]):
        docs = hot + [(k + 10, "x y " * (k % 30)) for k in range(100)]
        by_seq = check(p.pack(docs_of(docs), p.default_tokenizer(), block_rows=50).collect(), docs)
        sizes = defaultdict(int)
        for k, own in by_seq.items():
            sizes[k >> 32] += len(own)
        assert len(sizes) == 20 and max(sizes.values()) < 150


def test_another_tokenizer(docs_of):
    import public_tokenizers

    rows = p.pack(docs_of([(1, "Hello  World\n")]), public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert rows[0].doc_tokens > 3
