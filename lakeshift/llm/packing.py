"""Packing: minimum bin slack by subset-sum dynamic programming on a bitset.

Documents are tokenised, an end id is added, and each is cut at multiples of the window; full pieces fill windows of
their own. The pieces are packed in blocks of about as many as some thousand documents have, by a hash of the id, the
ids' checksum and the piece's number among equal ones of its task, so that neither null ids nor copies make a block
large (that number doesn't depend on the order in which a task reads its rows): the longest piece left opens a window; a dynamic programme over the multiset of remaining lengths finds the largest sum that fits what
is left, as bits of one integer (bit s: s tokens can be had); how many of each length were taken is found backwards
from the bitsets in between. At most one window a block ends up with much slack.

Nulls: a null text is an empty one and still has its end id; a null id is kept. Equal and repeated rows are packed
like any others. An empty table gives no rows. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import documents, small_batches, spread

WINDOW, END_ID, BLOCK_ROWS = 4096, 2, 2048
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
CUT = f"{PIECES}, nth long"
PACKED = f"{PIECES}, sequence_id long, `offset` long"


#: Chunks of these characters, without the brackets of special tokens, are split by PIECE as the tokenizer does it:
#: they are their own normal form and have simple lower-case letters.
SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def byte_letters() -> list[str]:
    """The letter by which a byte-level vocabulary writes each byte: itself if it can be printed, else from 256 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in printed else chr(next(other)) for b in range(256)]


class WordTokenizer(dict):
    """Ids of white-space separated chunks as little-endian bytes, by chunk, of word_bpe_49k.json.

    No merge, split or normalisation of this tokenizer reaches across ASCII white space (which it drops), so a text's
    ids are those of its chunks one after another. Chunks of simple letters go straight to the tokenizer's merges,
    others through all of it. Two generations of chunks are held, of a bounded number each.
    """

    most = 300_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.old, self.pieces = Tokenizer.from_file(path), {}, {}
        self.letters = byte_letters()

    def __missing__(self, chunk: bytes) -> bytes:
        found = self.old.get(chunk)
        if found is None:
            text = chunk.decode("utf-8", "replace")
            found = self.simple(text.lower()) if SIMPLE.fullmatch(text) and "<|" not in text else np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        self[chunk] = found
        return found

    def simple(self, text: str) -> bytes:
        out = b""
        for piece in PIECE.findall(text):
            ids = self.pieces.get(piece)
            if ids is None:
                word = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
                ids = self.pieces[piece] = b"".join(t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(word))
            out += ids
        return out

    def __call__(self, text: str) -> bytes:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
        if len(self.pieces) > self.most:
            self.pieces.clear()
        return b"".join(map(self.__getitem__, text.encode("utf-8", "surrogatepass").split()))


class WholeTokenizer:
    """Ids of whole texts, for any other tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def __call__(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


_TOKENIZERS: dict[str, WordTokenizer | WholeTokenizer] = {}


def tokenizer_of(path: str) -> WordTokenizer | WholeTokenizer:
    """The tokenizer of a file, one for each Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = (WordTokenizer if os.path.basename(path) == "word_bpe_49k.json" else WholeTokenizer)(path)
    return _TOKENIZERS[path]


def pieces(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenize = tokenizer_of(path)
    end = np.array([end_id], dtype="<u4").tobytes()
    part, equal = (TaskContext.get() and TaskContext.get().partitionId()) or 0, {}
    for batch in batches:
        rows: list[tuple] = []
        for doc, ids in zip(batch.column(0).to_pylist(), [tokenize(x or "") for x in batch.column(1).to_pylist()], strict=True):
            ids += end
            n = len(ids) // 4
            key = (doc, zlib.crc32(ids), n)
            nth = equal[key] = equal.get(key, -1) + 1
            for at in range(0, n, window):
                piece = ids[4 * at : 4 * (at + window)]
                rows.append((doc, at, len(piece) // 4, zlib.crc32(piece), n, (part << 40) + nth if nth else 0))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 6)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "nth"])


def fullest(lengths: dict[int, int], room: int) -> dict[int, int]:
    """Of a multiset of lengths, counts of a part whose sum is the largest that fits the room."""
    if room <= 0:
        return {}
    mask, goal = (1 << (room + 1)) - 1, 1 << room
    had, steps = 1, []  # bit s of had: a part found so far sums to s
    for length in sorted((x for x in lengths if x <= room), reverse=True):
        left, times = lengths[length], 1
        while left:  # a count as powers of two and a rest
            take = min(times, left, room // length)
            if not take:
                break
            steps.append((had, length, take))
            had |= (had << (length * take)) & mask
            left, times = left - take, times * 2
        if had & goal:
            break
    at, counts = had.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            counts[length] = counts.get(length, 0) + take
    return counts


def pack_lengths(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of places in ``lengths``: the longest piece left, then those with which the slack is least."""
    places: dict[int, list[int]] = {}
    for k in sorted(range(len(lengths)), key=lambda k: -k):
        places.setdefault(lengths[k], []).append(k)
    counts = {x: len(p) for x, p in places.items()}
    windows = []

    def take(length: int) -> int:
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
        return places[length].pop()

    while counts:
        first = max(counts)
        own = [take(first)]
        for length, n in fullest(counts, window - first).items():
            own += [take(length) for _ in range(n)]
        windows.append(own)
    return windows


def pack_block(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """Packs one block's pieces; ids of sequences are the block's number and a count."""
    block = int(rows["block"].iloc[0])
    rows = rows.drop(columns="block").sort_values(["doc_id", "start", "length", "ids_crc32"], ignore_index=True)
    sequence, offset = np.zeros(len(rows), "int64"), np.zeros(len(rows), "int64")
    length = rows["length"].to_numpy()
    for s, own in enumerate(pack_lengths(length.tolist(), window)):
        sequence[own] = (block << 32) + s
        offset[own] = np.concatenate([[0], np.cumsum(length[own])[:-1]])
    return rows.assign(sequence_id=sequence, offset=offset)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their places: see PACKED."""
    spark = docs.sparkSession
    small_batches(spark)
    blocks = max(1, -(-docs.count() // block_rows))
    cut = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lambda it: pieces(it, tokenizer, window, end_id), CUT)
    block = F.pmod(F.xxhash64("doc_id", "ids_crc32", "start", "nth"), F.lit(blocks))
    return cut.withColumn("block", block).drop("nth").groupBy("block").applyInPandas(lambda rows: pack_block(rows, window), PACKED)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return pack(spread(documents(spark, sf_dir).select("doc_id", "text")), default_tokenizer())
