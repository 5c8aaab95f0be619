"""SimHash near-dedup: 64-bit fingerprints of 3-word shingles, linked at a few differing bits.

Links come from an inverted index over byte positions. Of two fingerprints at most three bits apart, at least five of
the eight positional bytes are shared. Postings are keyed by four positions and their bytes: the fourteen sets of four
positions whose numbers have no odd bit in common sum (a Steiner system S(3, 4, 8)) are such that any three positions
miss one of them, so each such pair meets in a posting list. For each pair that meets, the shared positional bytes are
tallied, pairs below five are dropped, and the differing bits of the others are counted.

Documents of equal fingerprint are one node, under their least id. Posting lists longer than a limit aren't expanded
into pairs: their fingerprints are compared in blocks by numpy, which returns a spanning forest of the links only.
Lists longer than ``longest`` are first split by a fifth shared byte, and those that still are by three of the six half
bytes that are left (three differing bits leave three of them whole): no list then has more than 2^12 fingerprints.

Nulls are empty texts, whose fingerprint is zero; a null id counts as larger than all others. Repeated rows share
their component. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import checkpointed, components, documents, shuffle_partitions, small_batches, spread

SEED, WORDS, BITS = 42, 3, 3
POSITIONS = [p for p in combinations(range(8), 4) if p[0] ^ p[1] ^ p[2] ^ p[3] == 0]
#: Posting lists up to this length are joined pair by pair; longer ones than LONGEST are split.
PAIRWISE, LONGEST = 128, 20_000
NO_ID = 2**63 - 1
#: A fingerprint is hot if it has more rows than HOT_ROWS and than one in MOST_HOT of all.
HOT_ROWS, MOST_HOT = 1000, 100_000
#: Which bits each byte value has.
BITS_OF = np.unpackbits(np.arange(256, dtype="u1")[:, None], axis=1, bitorder="little").astype("i8")


def shingles(text: str, words: int = WORDS) -> list[bytes]:
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if len(w) <= words:
        return [b" ".join(w)] if w else []
    return list(map(b" ".join, zip(*(w[k:] for k in range(words)), strict=False)))


def fingerprint(text: str) -> int:
    """Each bit is the majority of that bit in the shingles' hashes; repeats count."""
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in shingles(text)], dtype="<u8")
    n = len(h)
    if not n:
        return 0
    b = h.view("u1").reshape(n, 8)
    if n < 512:
        counts = np.unpackbits(b, axis=1, bitorder="little").sum(axis=0, dtype="i4")
    else:
        counts = np.concatenate([np.bincount(b[:, k], minlength=256) @ BITS_OF for k in range(8)])
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        f = np.array([fingerprint(x or "") for x in batch.column(1).to_pylist()], dtype="u8")
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(f.view("i8"))], names=["id", "rk", "fp"])


def masked(positions: tuple[int, ...]) -> int:
    m = sum(0xFF << (8 * p) for p in positions)
    return m - (1 << 64) if m >> 63 else m


def shared_bytes(a: Column, b: Column) -> Column:
    x = a.bitwiseXOR(b)
    return sum((x.bitwiseAND(F.lit(masked((p,)))) == 0).cast("int") for p in range(8))


def forest(fps: np.ndarray, bits: int, block: int = 2048) -> list[tuple[int, int]]:
    """Places of links that connect what is linked: breadth-first from each fingerprint not reached yet.

    Each fingerprint is compared once with those not reached so far, in blocks, so memory stays linear.
    """
    open_, links = np.arange(len(fps)), []
    while len(open_):
        front, open_ = open_[:1], open_[1:]
        while len(front) and len(open_):
            reached = np.full(len(open_), -1)
            for k in range(0, len(front), block):
                some = front[k : k + block]
                left = np.flatnonzero(reached < 0)
                for at in range(0, len(left), block):
                    part = left[at : at + block]
                    near = np.bitwise_count(fps[some][:, None] ^ fps[open_[part]][None, :]) <= bits
                    hit = near.any(axis=0)
                    reached[part[hit]] = some[near[:, hit].argmax(axis=0)]
            new = reached >= 0
            links += zip(reached[new].tolist(), open_[new].tolist(), strict=True)
            front, open_ = open_[new], open_[~new]
    return links


def long_list(table: pa.Table, bits: int) -> pa.Table:
    fps = table["fp"].to_numpy()
    found = np.array(forest(fps.view("u8"), bits), "i8").reshape(-1, 2)
    return pa.table({"a": fps[found[:, 0]], "b": fps[found[:, 1]]})


def near_links(nodes: DataFrame, bits: int = BITS, pairwise: int = PAIRWISE, longest: int = LONGEST) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, unique) at most ``bits`` (up to 3) apart."""
    masks = F.array(*[F.lit(masked(p)) for p in POSITIONS])
    postings = nodes.select("fp", F.posexplode(F.transform(masks, lambda m: m.bitwiseAND(F.col("fp")))).alias("q", "v"))
    lists = checkpointed(postings.groupBy("q", "v").agg(F.count("*").alias("n")).where("n > 1"))
    postings = postings.join(lists, ["q", "v"])
    short = postings.where(F.col("n") <= pairwise).select("q", "v", "fp")
    other = short.select("q", "v", F.col("fp").alias("fp2"))
    pairs = short.join(other, ["q", "v"]).where(F.col("fp") < F.col("fp2"))
    pairs = pairs.where(shared_bytes(F.col("fp"), F.col("fp2")) >= 8 - bits)
    links = pairs.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= bits).select(F.col("fp").alias("a"), F.col("fp2").alias("b"))
    most = lists.agg(F.max("n")).first()[0] or 0
    if most > pairwise:
        used = F.array([F.array([F.lit(x) for x in p]) for p in POSITIONS])[F.col("q")]
        long = postings.where(F.col("n") > pairwise).select(F.concat_ws(",", "q", "v").alias("key"), used.alias("used"), "fp", "n")
        if most > longest:
            # at most three of the other four bytes differ, so one is shared
            other = F.array_except(F.array(*[F.lit(x) for x in range(8)]), "used")
            fifth = long.where(F.col("n") > longest).select("key", "fp", "used", F.explode(other).alias("p"))
            byte = F.expr("shiftrightunsigned(fp, p * 8) & 255")
            fifth = fifth.select(F.concat_ws(",", "key", "p", byte).alias("key"), "fp", F.array_except(other, F.array("p")).alias("left"))
            long = long.where(F.col("n") <= longest).select("key", "fp")
            sizes = checkpointed(fifth.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > longest))
            if sizes.isEmpty():
                long = long.unionByName(fifth.select("key", "fp"))
            else:
                fifth = fifth.join(F.broadcast(sizes) if sizes.count() <= 100_000 else sizes, "key", "left")
                halves = F.flatten(F.transform("left", lambda p: F.array(p * 2, p * 2 + 1)))  # numbers of the six half bytes
                three = F.array(*[F.array(*map(F.lit, c)) for c in combinations(range(6), 3)])
                sixth = fifth.where("n IS NOT NULL").withColumn("halves", halves).withColumn("c", F.explode(three))
                half = lambda k: F.expr(f"shiftrightunsigned(fp, halves[c[{k}]] * 4) & 15")
                sixth = sixth.select(F.concat_ws(",", "key", F.array_join("c", "-"), *map(half, range(3))).alias("key"), "fp")
                long = long.unionByName(fifth.where("n IS NULL").select("key", "fp")).unionByName(sixth)
        links = links.unionByName(long.select("key", "fp").groupBy("key").applyInArrow(lambda t: long_list(t, bits), "a long, b long"))
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(id, rk, fp, component, root) for each row.

    component: the least id reachable over links, null if no member has an id. rk: a hash of the text, 0 for null.
    root: the least fingerprint of the component.
    """
    small_batches(docs.sparkSession)
    rk = F.when(F.col(text_col).isNotNull(), F.xxhash64(text_col)).otherwise(0)
    marked = checkpointed(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), rk.alias("rk")).mapInArrow(with_fingerprints, "id long, rk long, fp long"))
    # dealt anew: each task then makes a bounded number of postings
    nodes = checkpointed(marked.groupBy("fp").agg(F.min(F.coalesce("id", F.lit(NO_ID))).alias("rep"), F.count("*").alias("n")).repartition(shuffle_partitions(docs.sparkSession), "fp"))
    found = components(near_links(nodes.select("fp"), bits))
    rooted = nodes.join(found, nodes.fp == found.node, "left").select("fp", "rep", "n", F.coalesce("component", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("c"))
    of_fp = checkpointed(rooted.join(least, "root").select("fp", "root", "n", F.when(F.col("c") != NO_ID, F.col("c")).alias("component")))
    # fingerprints of very many rows (as that of empty texts) are broadcast: there are at most rows / limit
    limit = max(HOT_ROWS, marked.count() // MOST_HOT)
    told = ["id", "rk", "fp", "component", "root"]
    hot = F.broadcast(of_fp.where(F.col("n") > limit).drop("n"))
    return marked.join(hot, "fp").select(*told).unionByName(marked.join(hot.select("fp"), "fp", "left_anti").join(of_fp.where(F.col("n") <= limit).drop("n"), "fp").select(*told))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """The rows of docs of least id (then of least text hash) in each component, one row each."""
    found = near_duplicates(docs, id_col, text_col, bits)
    kept = found.where(F.col("id").eqNullSafe(F.col("component"))).groupBy("root").agg(F.min(F.struct("id", "rk")).alias("k")).select("k.id", "k.rk").distinct()
    rk = F.when(F.col(text_col).isNotNull(), F.xxhash64(text_col)).otherwise(0)
    rows = docs.withColumn("_rk", rk).withColumn("_id", F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)))
    side = kept.select(F.coalesce("id", F.lit(NO_ID)).alias("_id"), F.col("rk").alias("_rk")).hint("shuffle_hash")
    return rows.join(side, ["_id", "_rk"], "left_semi").dropDuplicates(["_id", "_rk"]).drop("_id", "_rk")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spread(documents(spark, sf_dir).select("doc_id", "text")))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
