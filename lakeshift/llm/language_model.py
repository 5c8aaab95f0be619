"""LM scoring: a weighted backoff automaton over word trigrams, distributed with the documents.

States are the contexts of the training tokens: two words, one word (or the start), none (the root). An arc of a state u
reads a word w that followed u in training, at the weight log10 P(w | u), and leads to the state of the longest context
that the words read make. Any other word takes the failure arc, at log10(m / (c(u) + m)), to the state without u's first
word, which reads w in its turn; the root has an arc for each word. P(w | u) = (c(u w) + m P(w | u without its first
word)) / (c(u) + m) with the add-1/2 unigram distribution, one class being all unknown words, at the root: every state's
probabilities sum to 1 (Dirichlet smoothing). A text is one left-to-right walk from the start; it carries the state and
adds up the weights.

The automaton of a large corpus fits no machine, so each block of documents (some megabytes, by the rows' places in
their files) gets the part it walks on. (1) A block counts its distinct words and pairs in its training documents, and
sends hashes (of 64 bits, two of which tell words, pairs and trigrams apart) and counts, sorted and packed, to buckets
by ranges of the hash. (2) A bucket adds up and returns to each block the totals in the order in which the block sent
its hashes, and whether other blocks have them too. (3) Trigrams that hold a pair which no other block has are the
block's own; the others are counted the same way. (4) The block's documents meet their totals, and each text is walked.
Nothing is pruned or capped. The blocks' documents are shuffled once and read three times.

Packets don't shrink as the corpus grows: a task sends to at most ``fan`` ranges, and beyond as many buckets, a range's
packets of ``fan`` blocks are added up in a step of their own, which sends and receives as one block.

Nulls are empty texts: one token, the end. A null id counts as the empty text in the fold. Repeated rows are documents
of their own. An empty table gives no rows; without training documents all words are unknown.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import documents, row_place, shuffle_partitions, small_batches
from lakeshift.llm.quality import fold

BLOCK_BYTES, BUCKET_BYTES, FAN, PRIOR = 8 << 20, 16 << 20, 2048, 60.0
END, START = xxhash.xxh64_intdigest(b" end") | 1, xxhash.xxh64_intdigest(b" start") | 1
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
CACHED, LANES = 1_000_000, 4096
PARTS = "bucket int, block long, hashes binary, counts binary"
TOTALS = "block long, bucket int, totals binary, tokens long, words long"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_failures long"


class Hashes(dict):
    """Words' hashes; odd, as those of pairs and trigrams are even."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word) | 1
        return value


_HASHES = Hashes()


def packed(x: np.ndarray) -> bytes:
    """Equal bytes of all numbers one after another, compressed: high bytes are mostly equal."""
    return zstandard.ZstdCompressor(level=1).compress(x.view("u1").reshape(len(x), x.itemsize).T.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1")
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


_ZIP, _UNZIP = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose last column, the text, is compressed for the shuffle."""
    for batch in batches:
        texts = [_ZIP.compress((x or "").encode("utf-8", "surrogatepass")) for x in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary())], names=batch.schema.names)


def joined(before: np.ndarray, token: np.ndarray, tag: int) -> np.ndarray:
    """Hashes of n-grams: of all words but the last, and that; the two low bits are the tag."""
    x = (before * M1) ^ (token * M2)
    x ^= x >> np.uint64(31)
    x *= M1
    return ((x ^ (x >> np.uint64(29))) & np.uint64(2**64 - 4)) | np.uint64(tag)


def walked(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts, one after another: the tokens, the pairs and trigrams that end with them, and each text's length.

    The start counts as a word before the first; a first token has no trigram (0).
    """
    all_, n = [], []
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if len(_HASHES) > CACHED:
            _HASHES.clear()
        h = np.empty(len(words) + 2, "u8")
        h[0], h[-1] = START, END
        h[1:-1] = np.fromiter(map(_HASHES.__getitem__, words), "u8", len(words))
        all_.append(h)
        n.append(len(words) + 1)
    h, n = np.concatenate(all_), np.array(n)
    first = np.concatenate([[0], np.cumsum(n + 1)[:-1]])
    follows = np.ones(len(h), bool)
    follows[first] = False
    at = np.flatnonzero(follows)
    tokens = h[at]
    pairs = joined(h[at - 1], tokens, 0)
    triples = joined(np.concatenate([pairs[:1], pairs[:-1]]), tokens, 2)
    triples[np.concatenate([[0], np.cumsum(n)[:-1]])] = 0
    return tokens, pairs, triples, n


class Block:
    """A block's documents in an order of their own, their n-grams, and what its training documents count of them."""

    def __init__(self, docs: pa.Table):
        self.docs = docs.sort_by([("doc_id", "ascending"), ("n", "ascending")])
        self.number = docs["block"][0].as_py()
        tokens, pairs, self.triples, self.n = walked([_UNZIP.decompress(x).decode("utf-8", "surrogatepass") for x in self.docs["text"].to_pylist()])
        self.taught = np.repeat(~self.docs["held_out"].to_numpy(), self.n)
        self.hashes, at = np.unique(np.concatenate([tokens, pairs]), return_inverse=True)
        self.token_at, self.pair_at = at[: len(tokens)], at[len(tokens) :]
        self.counts = np.bincount(at[np.concatenate([self.taught, self.taught])], minlength=len(self.hashes))
        self.first = np.concatenate([[0], np.cumsum(self.n)[:-1]])

    def trigrams(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct trigrams, their counts here, where each token's is, and which of them other blocks may have."""
        hashes, first, at = np.unique(self.triples, return_index=True, return_inverse=True)
        counts = np.bincount(at[self.taught], minlength=len(hashes))
        open_ = shared[self.pair_at[first]] & shared[self.pair_at[first - 1]] & (hashes > 0)
        return hashes, counts, at, open_


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Which of equal ranges of all hashes, by the high bits."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype("i8")


def parts_of(hashes: np.ndarray, counts: np.ndarray, block: int, ranges: int, shared: np.ndarray | bool = False) -> list[tuple]:
    """Rows of PARTS: sorted hashes as differences, by ranges; ranges without any have no row.

    Twice the count is sent, and one more if the hash is known to be several blocks'.
    """
    if not len(hashes):
        return []
    where = range_of(hashes, ranges)
    cuts = np.flatnonzero(np.diff(where)) + 1
    edges = [0, *cuts.tolist(), len(hashes)]
    counts = counts.astype("<u8") * np.uint64(2) + np.asarray(shared, "<u8")
    delta = lambda x: np.diff(x, prepend=np.uint64(0)).astype("<u8")
    return [(int(where[a]), block, packed(delta(hashes[a:b])), packed(counts[a:b])) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def table_of(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True) if rows else [[]] * len(fields), fields, strict=True)], names=[n for n, _ in fields])


def hashes_in(table: pa.Table) -> list[np.ndarray]:
    return [np.cumsum(unpacked(x, "<u8"), dtype="u8") for x in table["hashes"].to_pylist()]


def summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct hashes of all parts, the sums of their counts, whether several blocks have them, and where each part's are."""
    parts = hashes_in(table)
    hashes, back = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.concatenate([unpacked(x, "<u8") for x in table["counts"].to_pylist()])
    total, shared = np.zeros(len(hashes), "<u8"), np.bincount(back, minlength=len(hashes)) > 1
    np.add.at(total, back, counts >> np.uint64(1))
    shared[back[(counts & np.uint64(1)).astype(bool)]] = True
    return hashes, total, shared, np.split(back, np.cumsum([len(p) for p in parts])[:-1])


def add_up(table: pa.Table) -> pa.Table:
    """A bucket's totals for each part, doubled, and one more if several blocks have the hash; the first row has the number of tokens and of distinct words taught."""
    hashes, total, shared, places = summed(table)
    word = (hashes & np.uint64(1)).astype(bool)
    tokens, words = int(total[word].sum()), int((total[word] > 0).sum())
    told = total * np.uint64(2) + shared
    rows = [(b, k, packed(told[at]), tokens if j == 0 else 0, words if j == 0 else 0) for j, (b, k, at) in enumerate(zip(table["block"].to_pylist(), table["bucket"].to_pylist(), places, strict=True))]
    return table_of(rows, TOTALS)


def gathered(table: pa.Table, group: int, ranges: int) -> pa.Table:
    """Parts of many blocks in one range as those of one block, in finer ranges."""
    hashes, total, shared, _ = summed(table)
    return table_of(parts_of(hashes, total, group, ranges, shared), PARTS)


def given_back(parts: pa.Table, totals: pa.Table) -> pa.Table:
    """What a group of blocks gets, for each of them."""
    *_, places = summed(parts)
    told = np.concatenate([unpacked(x, "<u8") for x in totals.sort_by("bucket")["totals"].to_pylist()])
    rows = [(b, k, packed(told[at]), 0, 0) for b, k, at in zip(parts["block"].to_pylist(), parts["bucket"].to_pylist(), places, strict=True)]
    return table_of(rows, TOTALS)


def exchange(parts: DataFrame, ranges: int, buckets: int, fan: int) -> tuple[DataFrame, DataFrame]:
    """(totals of all blocks' parts, the buckets' rows with numbers of tokens and words)."""
    if buckets <= ranges:
        totals = parts.groupBy("bucket").applyInArrow(add_up, TOTALS)
        return totals, totals
    group = F.col("bucket").cast("long") * (1 << 32) + F.floor(F.col("block") / fan)
    grouped = parts.withColumn("group", group).repartition(shuffle_partitions(parts.sparkSession), "group")
    fine = grouped.groupBy("group").applyInArrow(lambda t: gathered(t, t["group"][0].as_py(), buckets), PARTS)
    up = fine.groupBy("bucket").applyInArrow(add_up, TOTALS)
    return grouped.groupBy("group").cogroup(up.groupBy("block")).applyInArrow(given_back, TOTALS), up


def count_block(docs: pa.Table, ranges: int) -> pa.Table:
    block = Block(docs)
    return table_of(parts_of(block.hashes, block.counts, block.number, ranges), PARTS)


def totals_in(table: pa.Table, kind: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Totals of the block's n hashes, and whether other blocks have them."""
    rows = table.filter(pa.compute.equal(table["kind"], kind)).sort_by("bucket")["totals"].to_pylist()
    told = np.concatenate([unpacked(x, "<u8") for x in rows]) if rows else np.zeros(0, "u8")
    if len(told) != n:
        raise RuntimeError("a block's documents changed between its readings")
    return told >> np.uint64(1), (told & np.uint64(1)).astype(bool)


def count_trigrams(docs: pa.Table, totals: pa.Table, ranges: int) -> pa.Table:
    if not len(docs):
        return table_of([], PARTS)
    block = Block(docs)
    hashes, counts, _, open_ = block.trigrams(totals_in(totals, 0, len(block.hashes))[1])
    return table_of(parts_of(hashes[open_], counts[open_], block.number, ranges), PARTS)


def walk(block: Block, totals: np.ndarray, trigrams: np.ndarray, n_tokens: int, n_words: int, prior: float) -> tuple:
    """Base scores, scores, known tokens and failures by text; trigrams: each token's total.

    The texts' tokens, one after another, are cut in lanes, which are walked at once, step by step; a lane that begins
    inside a text begins in the state that the words before it make. depth: the number of words in the state's context.
    """
    c1, c2, c3 = totals[block.token_at].astype("f8"), totals[block.pair_at].astype("f8"), trigrams.astype("f8")
    starts = np.zeros(len(c1), bool)
    starts[block.first] = True
    last = block.first + block.n - 1
    before = np.concatenate([[0.0], c1[:-1]])
    before[block.first] = c1[last]  # as many starts as ends
    before2 = np.concatenate([[0.0], c2[:-1]])
    root = np.log10((c1 + 0.5) / (n_tokens + 0.5 * (n_words + 1)))
    p2 = (c2 + prior * 10**root) / (before + prior)
    arcs = [root, np.log10(p2), np.log10((c3 + prior * p2) / (before2 + prior))]
    failures = [None, np.log10(prior / (before + prior)), np.log10(prior / (before2 + prior))]
    follows = [None, c2 > 0, c3 > 0]
    size = len(c1)
    lane = max(1, -(-size // LANES))
    begins = np.arange(0, size, lane)
    depth = np.where(before2[begins] > 0, 2, (before[begins] > 0).astype("i8"))
    weight, fails = np.zeros(size), np.zeros(size, "i8")
    for step in range(lane):
        at = begins + step
        at = at[at < size]
        depth = depth[: len(at)]
        depth[starts[at]] = 1
        reads = np.zeros(len(at), "i8")  # the depth of the state that reads the token
        for d in (2, 1):
            here = (depth >= d) & (reads == 0)
            found = here & follows[d][at]
            reads[found] = d
            lost = at[here & ~found]
            weight[lost] += failures[d][lost]
            fails[lost] += 1
        weight[at] += np.choose(reads, [a[at] for a in arcs])
        depth = np.where(reads > 0, 2, (c1[at] > 0).astype("i8"))
    add = lambda x: np.add.reduceat(x, block.first)
    return add(root), add(weight), add((c1 > 0).astype("i8")), add(fails)


def score_block(docs: pa.Table, totals: pa.Table, prior: float) -> pa.Table:
    names = [x.split()[0] for x in SCORED.split(", ")]
    if not len(docs):
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
        return pa.table([pa.array([], k) for k in kinds], names=names)
    block = Block(docs)
    total, shared = totals_in(totals, 0, len(block.hashes))
    n_tokens, n_words = pa.compute.max(totals["n_tokens"]).as_py(), pa.compute.max(totals["n_words"]).as_py()
    hashes, counts, at, open_ = block.trigrams(shared)
    trigrams = counts.astype("u8")
    trigrams[open_] = totals_in(totals, 1, int(open_.sum()))[0]
    trigrams[hashes == 0] = 0
    base, score, known, fails = walk(block, total, trigrams[at], n_tokens, n_words, prior)
    n = len(block.n)
    return pa.table([block.docs["doc_id"], block.docs["held_out"], pa.array(block.n, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(n, n_tokens), pa.int64()), pa.array(base), pa.array(score), pa.array(fails, pa.int64())], names=names)


def lm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, fan: int = FAN) -> DataFrame:
    """Scores of all documents by a model of those that aren't held out."""
    spark = docs.sparkSession
    small_batches(spark)
    n = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    place = row_place(docs)
    # rows that don't come from files are spread by what they hold, so that wholly equal ones share a block
    place = F.xxhash64(id_col, text_col) if place is None else place
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), n.alias("n"), place.alias("place"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum("n")).first()[0] or 0
    blocks, buckets = max(1, -(-size // block_bytes)), max(1, -(-size // bucket_bytes))
    ranges, many = min(buckets, fan), shuffle_partitions(spark)
    block = F.pmod("place", F.lit(blocks)).cast("long").alias("block")
    blocked = rows.select("doc_id", "held_out", "n", block, "text").mapInArrow(zipped, "doc_id long, held_out boolean, n long, block long, text binary").repartition(many, "block")
    parts = blocked.groupBy("block").applyInArrow(lambda t: count_block(t, ranges), PARTS)
    totals, numbers = exchange(parts, ranges, buckets, fan)
    numbers = numbers.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n_tokens"), F.coalesce(F.sum("words"), F.lit(0)).alias("n_words"))
    of = lambda df, kind: df.select("block", "bucket", "totals", F.lit(kind).alias("kind"))
    totals = of(totals, 0).crossJoin(F.broadcast(numbers)).repartition(many, "block")  # one row
    more = blocked.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(lambda d, t: count_trigrams(d, t, ranges), PARTS)
    more, _ = exchange(more, ranges, buckets, fan)
    none = F.lit(None).cast("long")
    both = totals.unionByName(of(more, 1).select("*", none.alias("n_tokens"), none.alias("n_words")).repartition(many, "block"))
    return blocked.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(lambda d, t: score_block(d, t, prior), SCORED)


def op2_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir), fold() == 1)
