"""Document fingerprints of closed syncmers.

A k-mer of the text's UTF-8 bytes is a closed syncmer if the least hash of its inner s-mers is that of the first or
the last one. Whether a k-mer is chosen depends on the k-mer alone, so an unchanged passage keeps all its anchors,
whatever happens around it. The fingerprint holds the ``size`` distinct anchors of least hash with their first
positions (all of them in short texts): 4 + 4 bytes each in base64. The likeness of two fingerprints is 2m / (m + u):
u is the number of the least anchors of their union (``size`` at most), m how many of these both hold at the same
shift of positions, the commonest one; it estimates which share of the two texts they have in common.

A text shorter than k has one anchor, the whole text; an empty text's fingerprint is empty, and two empty ones are
alike (1). Nulls are empty texts. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import documents, shuffle_partitions, small_batches

K, S, SIZE = 16, 8, 48
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * M1
    x ^= x >> np.uint64(32)
    x *= M2
    x ^= x >> np.uint64(29)
    return x


def syncmers(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the text's closed syncmers."""
    n = len(data)
    if n < K:
        return np.array([xxhash.xxh64_intdigest(data)] if n else [], dtype="u8"), np.zeros(min(n, 1), "i8")
    words = np.empty(n - S + 1, dtype="<u8")
    for r in range(min(S, len(words))):
        words[r::S] = np.frombuffer(data, "<u8", count=(n - r) // S, offset=r)
    h = mixed(words)
    span = K - S + 1  # s-mers in a k-mer
    least, have = h, 1
    while have * 2 <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < span:
        least = np.minimum(least[: len(least) - (span - have)], least[span - have :])
    at = np.flatnonzero((h[: len(least)] == least) | (h[span - 1 :] == least))
    return mixed(h[at] ^ (h[at + K - S] * M2)), at


def sketch(data: bytes, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """The least distinct anchors, ascending, with their first positions."""
    hashes, at = syncmers(data)
    if len(hashes) > 8 * size:
        part = np.argpartition(hashes, 4 * size)[: 4 * size]
        limit = hashes[part].max()
        part = np.flatnonzero(hashes <= limit)
        few, first = np.unique(hashes[part], return_index=True)
        if len(few) >= size:
            return few[:size], at[part[first[:size]]]
    few, first = np.unique(hashes, return_index=True)
    return few[:size], at[first[:size]]


def rendered(anchors: tuple[np.ndarray, np.ndarray]) -> str:
    hashes, at = anchors
    out = np.empty((len(hashes), 2), dtype="<u4")
    out[:, 0], out[:, 1] = hashes >> np.uint64(32), at
    return base64.b64encode(out.tobytes()).decode()


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], size: int = SIZE) -> float:
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    union = np.union1d(a[0], b[0])[:size]
    keep = both <= union[-1]
    shifts = a[1][i[keep]].astype("i8") - b[1][j[keep]].astype("i8")
    m = int(np.unique(shifts, return_counts=True)[1].max()) if len(shifts) else 0
    return 2 * m / (m + len(union))


def edited(text: str, following: str) -> str:
    """The last third of the text gives way to the beginning of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, halo, doc_id, text) in order of the bucket, then of the documents; results of those that aren't halo."""
    waiting = None
    for batch in batches:
        rows: list[tuple] = []
        for bucket, halo, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            # an empty row of halo still ends the row before
            if waiting is not None and waiting[0] == bucket and not waiting[1]:
                marks = sketch(data)
                _, _, own_doc, own_text, own_marks = waiting
                changed = edited(own_text, text).encode("utf-8", "surrogatepass")
                other = sketch(changed)
                rows.append((own_doc, len(own_text), hashlib.sha256(changed).hexdigest(), rendered(own_marks), rendered(other), likeness(own_marks, other), likeness(own_marks, marks)))
            else:
                marks = None if halo else sketch(data)
            waiting = (bucket, halo, doc, text, marks)
        columns = zip(*rows, strict=True) if rows else [[]] * 7
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])


def bucket_of(key: Column, cuts: list[int], step: int = 64) -> Column:
    """The number of cuts below the key, by two short scans."""
    coarse = F.array(*[F.lit(c) for c in cuts[step - 1 :: step]]) if len(cuts) >= step else None
    fine = F.array(*[F.lit(c) for c in cuts])
    if coarse is None:
        return F.size(F.filter(fine, lambda c: c < key))
    skip = F.size(F.filter(coarse, lambda c: c < key)) * step
    return (skip + F.size(F.filter(F.slice(fine, skip + 1, step), lambda c: c < key))).cast("int")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 128, most_buckets: int = 8192) -> DataFrame:
    """Fingerprints of each document, of its edited text, and likenesses to that and to the next document.

    Next is by descending id (nulls last), then by the text; after the last comes the first. Documents go to buckets
    of consecutive ids whose bounds are ids of the table, in one shuffle; the first document of each bucket also goes
    to the bucket before it. Each task then reads its buckets in order and holds one text at a time besides the batch.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.coalesce(F.col(id_col), F.lit(-(2**63))).cast("long").alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = rows.select("key").count()
    buckets = max(1, min(most_buckets, n // bucket_rows))
    if n:
        points = [k / buckets for k in range(1, buckets + 1)]
        cuts = rows.agg(F.percentile_approx("key", points, 20 * buckets + 1000), F.max("key")).first()
        cuts = sorted({*cuts[0], cuts[1]})
    else:
        cuts = [0]
    last = len(cuts) - 1
    own = bucket_of(F.col("key"), cuts)
    is_cut = F.element_at(F.array(*[F.lit(c) for c in cuts]), F.col("own") + 1) == F.col("key")
    target = F.when(F.col("own") == last, F.lit(0)).otherwise(F.col("own") + 1)
    placed = rows.withColumn("own", own).withColumn(
        "place", F.explode(F.when(is_cut, F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("halo")), F.struct(target.cast("int").alias("bucket"), F.lit(True).alias("halo")))).otherwise(F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("halo")))))
    )
    return (
        placed.select("place.bucket", "place.halo", "key", "doc_id", "text")
        .repartition(shuffle_partitions(spark), "bucket")
        .sortWithinPartitions("bucket", "halo", F.desc("key"), "text")
        .select("bucket", "halo", "doc_id", "text")
        .mapInArrow(neighbours, SCHEMA)
    )


def op1_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
