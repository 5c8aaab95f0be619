"""Quality classifier: supervised subword embeddings, trained by stochastic gradient descent in numpy.

A word's vector is the mean of the learned vectors of its features: the word and its character n-grams, each hashed to
one of ``buckets`` rows. A word that repeats the one before it adds one more feature, the repeat. A document's vector
is the mean over its words and repeats, and a softmax layer gives the probabilities of the two labels. Words are what
ASCII white space separates; case and punctuation stay. labels, lang, source and ids are no inputs.

Training takes at most ``most`` labelled documents (those of least hash of their id, a bounded sample). Executors turn
these into bags of features; the driver runs the descent. As the network is linear in the features' vectors before the
softmax, scoring needs one number a feature (its vector's part in the difference of the logits), which is shipped to
the executors: ``buckets`` floats. They score whole texts with a bounded cache of words.

Nulls are empty texts, whose score is that of the bias. Null labels and labels without a document teach nothing; with
no labels of both kinds each score is the share of label 1 (0.5 without any). Repeated rows are scored like any other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import documents, shuffle_partitions, small_batches, spread

BUCKETS, DIM, GRAMS, EPOCHS, RATE, MOST, THRESHOLD = 1 << 17, 8, (3, 4), 6, 0.5, 4000, 0.3
REPEAT = 0
CACHED = 500_000


def features(word: bytes, buckets: int = BUCKETS) -> list[int]:
    """Rows of a word: its own and those of its n-grams, with marks at both ends."""
    digest, marked = xxhash.xxh32_intdigest, b"<" + word + b">"
    out = [1 + digest(word, 7) % (buckets - 1)]
    for n in GRAMS:
        out += [1 + digest(marked[k : k + n], n) % (buckets - 1) for k in range(len(marked) - n + 1)]
    return out


def repeats(words: list[bytes]) -> int:
    return sum(map(bytes.__eq__, words, words[1:]))


def bag(text: str, buckets: int = BUCKETS, known: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text with weights that sum to 1; known: words' features, to be filled."""
    known = {} if known is None else known
    words = text.encode("utf-8", "surrogatepass").split()
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    again = repeats(words)
    ids, weights = [[REPEAT]], [[again]]
    for w, c in counts.items():
        f = known.get(w) or known.setdefault(w, features(w, buckets))
        ids.append(f)
        weights.append([c / len(f)] * len(f))
    ids, back = np.unique(np.concatenate([np.array(x, "i8") for x in ids]), return_inverse=True)
    total = np.bincount(back, np.concatenate([np.array(x, "f8") for x in weights]))
    return ids.astype("i4"), (total / max(1, len(words) + again)).astype("f4")


def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict = {}
        found = [bag(x or "", known=known) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f[0].tobytes() for f in found], pa.binary()), pa.array([f[1].tobytes() for f in found], pa.binary())], names=["key", "label", "ids", "weights"])


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = 1) -> tuple[np.ndarray, float]:
    """Each feature's part in logit(label 1), and the bias."""
    ones = sum(y for _, _, y in rows)
    if not 0 < ones < len(rows):
        return np.zeros(buckets, "f4"), 0.0 if not rows else (20.0 if ones else -20.0)
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype("f4")
    out, bias = np.zeros((2, dim), "f4"), np.zeros(2, "f4")
    # the rarer label counts as much as the other in all
    class_weight = (0.5 * len(rows) / (len(rows) - ones), 0.5 * len(rows) / ones)
    done, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for k in random.permutation(len(rows)):
            ids, w, y = rows[k]
            lr = rate * (1 - done / steps)
            done += 1
            own = vectors[ids]
            x = w @ own
            z = out @ x + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= class_weight[y]
            toward = p @ out
            out -= lr * np.outer(p, x)
            bias -= lr * p
            # features of a text share its mean's gradient; as in averaging models it isn't divided by their number
            vectors[ids] = own - (lr * np.minimum(1, w * len(w)))[:, None] * toward
    return vectors @ (out[1] - out[0]), float(bias[1] - bias[0])


class Parts(dict):
    """A word's part in the logit, by the mean over its features."""

    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table = table.tolist()

    def __missing__(self, word: bytes) -> float:
        f = features(word, len(self.table))
        value = self[word] = sum(map(self.table.__getitem__, f)) / len(f)
        return value


_PARTS: dict[int, Parts] = {}


def scores(batches: Iterator[pa.RecordBatch], table: np.ndarray, bias: float) -> Iterator[pa.RecordBatch]:
    key = hash((table.tobytes(), bias))
    if key not in _PARTS:
        _PARTS.clear()
        _PARTS[key] = Parts(table)
    parts = _PARTS[key]
    again_part = parts.table[REPEAT]
    for batch in batches:
        out = []
        for x in batch.column(batch.num_columns - 1).to_pylist():
            words = (x or "").encode("utf-8", "surrogatepass").split()
            again = repeats(words)
            z = (math.fsum(map(parts.__getitem__, words)) + again * again_part) / max(1, len(words) + again) + bias
            out.append(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))))
            if len(parts) > CACHED:
                parts.clear()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, "_score"])


def fit(docs: DataFrame, labels: DataFrame, keep: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MOST) -> tuple[np.ndarray, float]:
    """The model of at most ``most`` labelled documents for which ``keep`` (a Column over the id) holds."""
    small_batches(docs.sparkSession)
    label = labels.where(F.col(label_col).isin(0, 1))
    if keep is not None:
        label = label.where(keep)
    sample = label.select(F.col(id_col).alias("_id"), F.col(label_col).cast("long").alias("label")).orderBy(F.xxhash64("_id"), "_id", "label").limit(most)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "_id").orderBy(F.xxhash64("_id"), "label", F.xxhash64("text")).limit(most)
    rows = texts.select(F.xxhash64("_id").alias("key"), "label", "text").repartition(shuffle_partitions(docs.sparkSession)).mapInArrow(bags, "key long, label long, ids binary, weights binary").collect()
    rows.sort(key=lambda r: (r.key, r.label, bytes(r.ids), bytes(r.weights)))  # whatever order they came in
    return train([(np.frombuffer(r.ids, "i4"), np.frombuffer(r.weights, "f4"), r.label) for r in rows])


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns, and ``_score``: the probability of label 1."""
    small_batches(docs.sparkSession)
    table, bias = model
    carry = docs.columns if carry is None else carry
    rows = docs.select(*carry, F.col(text_col).alias("_text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", _score double"
    return rows.mapInArrow(lambda it: scores(it, table, bias), schema).drop("_text")


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo 5; that of the empty text for nulls."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, documents(spark, sf_dir, "labels"), fold() != 0)
    found = score(spread(docs.select("doc_id", "text")), model, carry=["doc_id"])
    return found.select("doc_id", (fold() == 0).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
