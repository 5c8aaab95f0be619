"""Substring dedup: compact windows of min-hashes find passages of 50 words or more that documents share.

A text is its sequence of 5-word shingles (lower-cased A-Z). For a hash function, the Cartesian tree over the shingles'
hashes has a node for each position c, whose subtree (l, r) is the widest stretch in which c has the least hash. Each
node at least ``span`` shingles wide is a compact window: all passages within (l, r) that hold c and are long enough
have the min-hash of c. Two passages that agree on a min-hash so have windows of equal key, and the windows of one text
are about 2n / span for each of ``functions`` hash functions. A node that wide is the minimum of a sliding window, so
that only these are put on the tree's stack.

(1) Tasks read the texts, send each window's key (its shingle) packed in buckets by ranges of the key, and note each
text's hash and number of words. A key that is frequent in one unit of texts goes by units instead, but for two windows,
so that no bucket gets all windows of a boilerplate line. Beyond ``fan`` buckets, packets take two steps: by coarse
ranges, then, gathered from many units, by fine ones, so that they don't shrink as the corpus grows. (2) A bucket finds
keys in different texts; equal texts count once. (3) The texts of these windows are read again, and each window gets one
byte for each shingle up to ``span`` - 1 to both sides; windows of a text with equal bytes become one, with a list of its
places. (4) Windows of one key are compared: two are linked if some ``span`` shingles around c have a Jaccard
similarity of 0.8 at least (41 of 46 shared; words may be missing or new: places may shift by up to two). Links connect
all that agree: windows meet those that aren't in their component yet, so that no group becomes all its pairs.
In large groups only windows that share bytes to one side of the middle, shifted or not, are compared: all that can agree
share some, and those that tell windows apart best are taken (each two meet once where none do, as in texts of few
words). Keys with more windows than a task should hold are dealt to salts, and each two salts are compared in a task, so
that all windows of a key meet (agreement isn't transitive: no window can stand for those like it). What a
window shares exactly with any other of its key, and not only with its partners, is found by hashes of
its stretches and widens its span. (5) Links between texts and exact copies give the documents' classes.

A shingle that repeats takes part in the minima once in ``span`` positions only, so that text that repeats a word or
phrase makes no window at each place. (Without this rule the comparisons take ten times as long; see the README.)

Nulls and texts of fewer than 50 words have no passages and are a class of their own. A null id is a node like any
other (and comes back as null). Repeated rows are exact copies. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeshift.llm.common import checkpointed, components, documents, shuffle_partitions, small_batches, spread
from lakeshift.llm.language_model import _HASHES, CACHED, packed, unpacked

SHINGLE, LEAST_WORDS, FUNCTIONS, SHIFT, SIMILARITY = 5, 50, 4, 2, 0.8
SPAN = LEAST_WORDS - SHINGLE + 1
#: Shared shingles of SPAN that make a Jaccard similarity of 0.8: s / (2 * SPAN - s).
ENOUGH = int(np.ceil(2 * SPAN * SIMILARITY / (1 + SIMILARITY)))
UNIT_BYTES, BLOCK_BYTES, BUCKET_BYTES, HELD, MANY, NO_ID = 16 << 20, 2 << 20, 40 << 20, 20_000, 64, -(2**63)
#: Windows of a key in a unit's texts from which they go by units; buckets that a task sends to; keys that are broadcast.
LOCAL, FAN, MOST_KEYS = 512, 1024, 1_000_000
#: Pairs of neighbours to one side of a window, and how many of them are whole where windows agree.
PAIRS = SPAN // 4
NEEDED = PAIRS - (SPAN - ENOUGH)
#: Bytes of a window when it is compared, with zeros at the end: a multiple of eight, SHIFT more than it has at least.
WIDE = -(-(2 * SPAN - 1 + SHIFT) // 8) * 8
#: Candidates, and pairs that are compared, at once; pairs of a group from which it is divided further; neighbours of a row.
CANDIDATES, COMPARED, CROWD, NEXT = 1 << 16, 1 << 12, 1 << 17, 8
M1, M2, NEVER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(2**64 - 1)
SENT = "bucket int, unit long, doc_id long, text_hash long, words long, keys binary, docs binary, at binary"
PACKETS = "bucket int, unit long, keys binary, docs binary, at binary"


def shingle_hashes(text: str) -> tuple[np.ndarray, int]:
    """A hash for each 5 words, and the number of words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, "u8"), len(words)
    if len(_HASHES) > CACHED:
        _HASHES.clear()
    h = np.fromiter(map(_HASHES.__getitem__, words), "u8", len(words))
    out = h[:n].copy()
    for k in range(1, SHINGLE):
        out *= M1
        out ^= out >> np.uint64(29)
        out += h[k : k + n]
    out *= M2
    return out ^ (out >> np.uint64(32)), len(words)


def sliding_least(x: np.ndarray, span: int) -> np.ndarray:
    have = 1
    while have * 2 <= span:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (span - have)], x[span - have :]) if have < span else x


def eligible_in(h: np.ndarray, span: int) -> np.ndarray:
    """Whether a shingle takes part: at its first place, and where the last one that does is ``span`` positions before."""
    order = np.argsort(h, kind="stable")
    near = np.flatnonzero((h[order][1:] == h[order][:-1]) & (np.diff(order) < span)) + 1
    out, before, last = np.ones(len(h), bool), -1, 0
    for k, at, to in zip(near.tolist(), order[near].tolist(), order[near - 1].tolist(), strict=True):
        if k - 1 != before:
            last = to
        if at - last < span:
            out[at] = False
        else:
            last = at
        before = k
    return out


def compact_windows(x: np.ndarray, span: int) -> list[tuple[int, int, int]]:
    """(l, c, r) of each Cartesian tree node at least ``span`` wide; x: hashes, the first of equal ones is less.

    The greatest hash stands for places that can't be a minimum: they are in windows but have none of their own.
    """
    n = len(x)
    if n < span:
        return []
    least = sliding_least(x, span)
    places = np.flatnonzero((x <= np.max(least)) & (x < NEVER))
    if not len(places):
        return []
    # the minimum of some window: compare with the windows' minima around each place
    lo, hi = np.maximum(places - span + 1, 0), np.minimum(places, len(least) - 1)
    top = np.concatenate([least, np.zeros(1, x.dtype)])
    # the largest of the minima of windows that hold the place is the place's own value if it is one of them
    most = np.maximum.reduceat(top, np.column_stack([lo, hi + 1]).ravel())[::2]
    nodes = places[x[places] <= most]
    out, stack = [], []  # stack: (place, left bound), values ascending
    values = x[nodes].tolist()
    for c, v in zip(nodes.tolist(), values, strict=True):
        left = stack[-1][0] + 1 if stack else 0
        while stack and stack[-1][2] > v:
            p, left, _ = stack.pop()
            if c - left >= span:
                out.append((left, p, c - 1))
        left = stack[-1][0] + 1 if stack else 0
        stack.append((c, left, v))
    while stack:
        p, left, _ = stack.pop()
        if n - left >= span:
            out.append((left, p, n - 1))
    return out


def window_places(h: np.ndarray, span: int = SPAN, functions: int = FUNCTIONS) -> np.ndarray:
    """Places of the compact windows of all hash functions."""
    if len(h) < span:
        return np.zeros(0, "i8")
    eligible, found = eligible_in(h, span), []
    for k in range(functions):
        x = (h ^ np.uint64(0x632BE59BD9B4E019 * (k + 1) & (2**64 - 1))) * M2
        x ^= x >> np.uint64(31)
        x *= M1
        x[~eligible] = NEVER
        found.append(np.array([c for _, c, _ in compact_windows(x, span)], "i8"))
    places = np.unique(np.concatenate(found))
    return places[eligible[places]]


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the keys' high bits."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype("i8")


def packets(keys: np.ndarray, texts: np.ndarray, at: np.ndarray, bucket: np.ndarray, unit: int) -> pa.RecordBatch:
    """A row of PACKETS for each bucket that has windows; the keys are sorted within each bucket. texts: hashes and ids."""
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(keys)]]) if len(keys) else np.zeros(1, "i8")
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        own, number = np.unique(texts[a:b], axis=0, return_inverse=True)
        ids = packed(own.astype("<i8").reshape(-1))
        out.append((int(bucket[a]), unit, packed(np.diff(keys[a:b], prepend=np.uint64(0)).astype("<u8")), len(ids).to_bytes(4, "little") + ids + packed(number.reshape(-1).astype("<u4")), packed(at[a:b].astype("<u4"))))
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, kinds, strict=True)], names=["bucket", "unit", "keys", "docs", "at"])


def opened(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of packets: keys, (text_hash, doc_id), places."""
    keys, texts, at = [np.zeros(0, "u8")], [np.zeros((0, 2), "i8")], [np.zeros(0, "u4")]
    for k, d, p in zip(table["keys"].to_pylist(), table["docs"].to_pylist(), table["at"].to_pylist(), strict=True):
        cut = 4 + int.from_bytes(d[:4], "little")
        keys.append(np.cumsum(unpacked(k, "<u8"), dtype="u8"))
        texts.append(unpacked(d[4:cut], "<i8").reshape(-1, 2)[unpacked(d[cut:], "<u4")])
        at.append(unpacked(p, "<u4"))
    return np.concatenate(keys), np.concatenate(texts), np.concatenate(at)


def sent(batches: Iterator[pa.RecordBatch], buckets: int, coarse: int, unit_bytes: int, local: int = LOCAL) -> Iterator[pa.RecordBatch]:
    """Rows of documents (bucket null) and of packed windows (see SENT), in ``coarse`` ranges of the buckets.

    A negative bucket holds windows of keys that are frequent in the unit.
    """
    names = [x.split()[0] for x in SENT.split(", ")]

    def batch_of(columns: dict, n: int) -> pa.RecordBatch:
        kinds = {"bucket": pa.int32(), "keys": pa.binary(), "docs": pa.binary(), "at": pa.binary()}
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, kinds.get(c, pa.int64())) for c in names], names=names)

    def windows(texts: dict) -> Iterator[pa.RecordBatch]:
        rows = list(texts.items())
        keys = np.concatenate([h[p] for _, (_, h, p) in rows] or [np.zeros(0, "u8")])
        ids = np.array([[t, d] for t, (d, _, _) in rows], "i8").reshape(-1, 2)[np.repeat(np.arange(len(rows)), [len(p) for _, (_, _, p) in rows])]
        at = np.concatenate([p for _, (_, _, p) in rows] or [np.zeros(0, "i8")])
        order = np.lexsort((ids[:, 0], keys))
        keys, ids, at = keys[order], ids[order], at[order]
        unit = int(ids[:, 0].min()) if len(ids) else 0
        new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        many = np.bincount(number, minlength=len(first))[number] > local
        # the first window, and the last, which is another text's if there is any, tell the key's bucket of it
        place = np.arange(len(keys))
        last = np.append(first[1:], len(keys)) - 1
        away = many & (place != first[number]) & (place != last[number])
        bucket = bucket_of(keys, buckets) * coarse // buckets
        for some, b in ((~away, bucket), (away, np.full(len(keys), -1 - unit % buckets))):
            found = packets(keys[some], ids[some], at[some], b[some], unit)
            yield batch_of({c: found.column(c) for c in found.schema.names}, found.num_rows)

    held, size = {}, 0
    for batch in batches:
        info = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or ""
            t = text_hash(text)
            if t in held:  # equal texts of a unit are one
                info.append((doc, t, held[t][3]))
                held[t] = (min(held[t][0], doc), *held[t][1:])
                continue
            h, words = shingle_hashes(text)
            info.append((doc, t, words))
            p = window_places(h)
            if len(p):
                held[t] = (doc, h, p, words)
                size += len(text)
        docs, hashes, words = zip(*info, strict=True) if info else ((), (), ())
        yield batch_of({"doc_id": pa.array(docs, pa.int64()), "text_hash": pa.array(hashes, pa.int64()), "words": pa.array(words, pa.int64())}, len(info))
        if size >= unit_bytes:
            yield from windows({t: x[:3] for t, x in held.items()})
            held, size = {}, 0
    yield from windows({t: x[:3] for t, x in held.items()})


def recut(table: pa.Table, buckets: int) -> pa.Table:
    """Packets of one coarse range and many units as packets of its buckets."""
    keys, texts, at = opened(table)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    return pa.Table.from_batches([packets(keys, texts[order], at[order], bucket_of(keys, buckets), table["unit"][0].as_py())])


def shared_keys(table: pa.Table) -> pa.Table:
    """Windows (key, doc_id, text_hash, at, n, away) of keys in different texts; each text once, under its least id here."""
    keys, texts, at = opened(table)
    hashes, docs = texts[:, 0], texts[:, 1]
    order = np.lexsort((docs, at, hashes, keys))
    keys, docs, hashes, at = keys[order], docs[order], hashes[order], at[order]
    new_text = np.concatenate([[True], (keys[1:] != keys[:-1]) | (hashes[1:] != hashes[:-1])])
    new_row = new_text | np.concatenate([[True], at[1:] != at[:-1]])
    new_key = np.concatenate([[True], keys[1:] != keys[:-1]])
    group = np.cumsum(new_key) - 1
    texts_of = np.bincount(group, new_text)
    away = table["bucket"][0].as_py() < 0
    keep = new_row & ((texts_of[group] > 1) | away)
    n = np.bincount(group, keep)[group][keep].astype("i8")
    return pa.table({"key": keys[keep].view("i8"), "doc_id": docs[keep], "text_hash": hashes[keep], "at": at[keep].astype("i8"), "n": n, "away": pa.array(np.full(len(n), away))})


def surroundings(docs: pa.Table, wanted: pa.Table) -> pa.Table:
    """The wanted windows with a byte for each shingle around (2 * SPAN - 1 bytes; 0 beyond the text).

    Windows of a text with equal keys and bytes are one, the first; more: the others' places.
    """
    by: dict = {}
    for k, (d, t) in enumerate(zip(wanted["doc_id"].to_pylist(), wanted["text_hash"].to_pylist(), strict=True)):
        by.setdefault((d, t), []).append(k)
    at, key, out = wanted["at"].to_numpy(), wanted["key"].to_numpy(), np.zeros((len(wanted), 2 * SPAN - 1), "u1")
    more, keep = [None] * len(wanted), np.zeros(len(wanted), bool)
    for d, text in zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist(), strict=True):
        if text and (rows := by.pop((d, text_hash(text)), None)):
            h, _ = shingle_hashes(text)
            small = np.zeros(len(h) + 2 * SPAN, "u1")
            small[SPAN : SPAN + len(h)] = 1 + (h >> np.uint64(40)) % np.uint64(255)
            rows = np.array(sorted(rows, key=at.__getitem__))
            for k in range(0, len(rows), 65536):
                some = rows[k : k + 65536]
                out[some] = small[at[some][:, None] + np.arange(1, 2 * SPAN)]
            if len(np.unique(key[rows])) < len(rows):
                first: dict = {}
                for r in rows.tolist():
                    first.setdefault((key[r], out[r].tobytes()), []).append(r)
                for r, *others in first.values():
                    keep[r] = True
                    more[r] = at[others].astype("<u4").tobytes() if others else None
            else:
                keep[rows] = True
    flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * SPAN - 1), len(out), [None, pa.py_buffer(np.ascontiguousarray(out))]).cast(pa.binary())
    found = pa.table([wanted["key"], wanted["text_hash"], wanted["at"], wanted["n"], flat, pa.array(more, pa.binary())], names=["key", "text", "at", "n", "around", "more"])
    return found.filter(pa.array(keep))


def agreeing(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows of bytes: whether some SPAN shingles that hold the middle agree; the first and last shingle that does.

    The ends are those of the widest stretch, without shingles that differ if it stays long enough.
    """
    width = 2 * SPAN - 1
    same = a == b
    for s in range(1, SHIFT + 1):
        same[:, s:] |= a[:, s:] == b[:, : width - s]
        same[:, : width - s] |= a[:, : width - s] == b[:, s:]
    beyond = (a == 0) | (b == 0)
    same[beyond] = False
    # a place beyond either text spoils the stretch
    total = np.zeros((len(same), width + 1), "i2")
    np.cumsum(np.where(beyond, -SPAN, same.view("i1")), axis=1, dtype="i2", out=total[:, 1:])
    good = total[:, SPAN:] - total[:, :SPAN] >= ENOUGH
    ok = good.any(axis=1)
    some, good, place = same[ok], good[ok], np.arange(width)
    lo, hi = good.argmax(axis=1), width - 1 - good[:, ::-1].argmax(axis=1)
    # one alone may agree by chance
    twice = some[:, :-1] & some[:, 1:]
    first = (twice & (place[:-1] >= lo[:, None])).argmax(axis=1)
    last = width - 1 - (twice & (place[1:] <= hi[:, None]))[:, ::-1].argmax(axis=1)
    long = last - first + 1 >= SPAN
    ends = np.zeros((2, len(ok)), "i8")
    ends[0, ok], ends[1, ok] = np.where(long, first, lo), np.where(long, last, hi)
    return ok, ends[0], ends[1]


def either_way(around: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """agreeing() of rows x and y or else of y and x: where places shift, these may differ by a shingle.

    Rows are WIDE bytes here, with zeros at their ends, so that a shift of all rows at once stays within them. Most pairs
    haven't enough shingles in all either way, which eight bytes at once tell.
    """
    width, n = 2 * SPAN - 1, len(x)
    a, b = around[x], around[y]
    one, other = a.reshape(-1), b.reshape(-1)
    same = one == other
    for s in range(1, SHIFT + 1):
        for found in (one[s:] == other[:-s], one[:-s] == other[s:]):
            same[s:] |= found
            same[:-s] |= found
    total = same.view("u8").reshape(n, WIDE // 8).sum(axis=1) * np.uint64(0x0101010101010101) >> np.uint64(56)
    rest = np.flatnonzero(total >= ENOUGH + WIDE - width)  # the zeros are equal
    ok, first, last = np.zeros(n, bool), np.zeros(n, "i8"), np.zeros(n, "i8")
    for p, q in ((a, b), (b, a)):
        if len(rest):
            ok[rest], first[rest], last[rest] = agreeing(p[rest, :width], q[rest, :width])
            rest = rest[~ok[rest]]
    return ok, first, last


class Labels:
    """The component of each row by the links so far."""

    def __init__(self, of: np.ndarray):
        self.of, self.same = of, np.arange(len(of))

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins the components of each pair of rows."""
        up: dict = {}

        def top(k: int) -> int:
            while (u := up.get(k, k)) != k:
                up[k] = k = up.get(u, u)
            return k

        for x, y in zip(self.of[a].tolist(), self.of[b].tolist(), strict=True):
            x, y = top(x), top(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        if up:
            old = list(up)
            self.same[old] = [top(k) for k in old]
            self.of = self.same[self.of]
            self.same[old] = old


def compared(around: np.ndarray, one: np.ndarray, many: np.ndarray, begin: np.ndarray, n: np.ndarray, labels: Labels) -> Iterator[np.ndarray]:
    """Links (a, b, first, last) between each row of ``one`` and n rows of ``many`` from ``begin`` on, where these aren't in one component yet."""
    ends = np.cumsum(n)
    cuts = np.searchsorted(ends, np.arange(0, int(ends[-1]) if len(ends) else 0, CANDIDATES), side="right").tolist()
    for i, j in zip(cuts, [*cuts, len(n)][1:], strict=True):
        some = n[i:j]
        k = np.repeat(np.arange(i, j), some)
        a, b = one[k], many[np.arange(len(k)) + np.repeat(begin[i:j] - (np.cumsum(some) - some), some)]
        apart = labels.of[a] != labels.of[b]
        a, b = a[apart], b[apart]
        for at in range(0, len(a), COMPARED):
            x, y = a[at : at + COMPARED], b[at : at + COMPARED]
            if at:
                apart = labels.of[x] != labels.of[y]
                x, y = x[apart], y[apart]
            ok, first, last = either_way(around, x, y)
            if ok.any():
                found = np.column_stack([x, y, first, last])[ok]
                labels.join(found[:, 0], found[:, 1])
                yield found


def connected(around: np.ndarray, rows: np.ndarray, group: np.ndarray, labels: Labels) -> Iterator[np.ndarray]:
    """Links among rows of each group (rows are sorted by it) that connect all that agree.

    Each row meets those after it that aren't in its component yet; the rows that do so at once, in all groups, double,
    as the first ones join most of what is alike.
    """
    at, step = 0, 1
    while len(rows):
        start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size, own = np.diff(np.append(start, len(rows))), labels.of[rows]
        open_ = np.logical_or.reduceat(own != np.repeat(own[start], size), start) & (size > at + 1)
        keep = np.repeat(open_, size)
        rows, group, size = rows[keep], group[keep], size[open_]
        if not len(rows):
            return
        end, n = np.cumsum(size), np.minimum(step, size - at)
        place = np.repeat(end - size + at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        yield from compared(around, rows[place], rows, place + 1, np.repeat(end, n) - place - 1, labels)
        at, step = at + step, 2 * step


def far_pair(around: np.ndarray, rows: np.ndarray, side: int, k: int, s: int = 0, t: int = 0) -> np.ndarray:
    """The k-th pair of neighbours to one side of the middle as a number, its shingles s and t places away."""
    at = SPAN - 1 + side * (2 + 2 * k)
    return around[rows, at + s].astype("u2") << 8 | around[rows, at + side + t]


def grouped(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of values, where equal ones start there, and how many they are."""
    order = np.argsort(value, kind="stable")
    start = np.flatnonzero(np.concatenate([[True], np.diff(value[order]) != 0])) if len(value) else np.zeros(0, "i8")
    return order, start, np.diff(np.append(start, len(value)))


def met(around: np.ndarray, rows: np.ndarray, side: int, labels: Labels, used: tuple[int, ...] = ()) -> Iterator[np.ndarray]:
    """Links among rows that connect all that agree on a stretch reaching to this side and without a shift.

    A stretch of SPAN shingles around the middle reaches SPAN / 2 to one side at least. Of eleven pairs of neighbours
    there, the five shingles that may differ leave six whole, so that rows which agree have one in common of any six:
    the six with the smallest groups are taken. A group that is large still is divided by the other pairs in the same way
    (used: pairs that all rows share), as long as this saves half of the comparisons at least.
    """
    by = {k: grouped(far_pair(around, rows, side, k)) for k in range(PAIRS) if k not in used}
    best = sorted(by, key=lambda k: (int((by[k][2] ** 2).sum()), -k))[:NEEDED]
    if sum(int((by[k][2] ** 2).sum()) for k in best) * 2 > len(rows) ** 2:
        yield from connected(around, rows, np.zeros(len(rows), "i8"), labels)
        return
    for k in best:
        order, start, size = by[k]
        large = np.zeros(len(start), bool)
        if len(used) < NEEDED - 1:
            for g in np.flatnonzero(size**2 > 2 * CROWD).tolist():
                some = rows[order[start[g] : start[g] + size[g]]]
                counts = np.unique(labels.of[some], return_counts=True)[1]
                if size[g] ** 2 - (counts**2).sum() > 2 * CROWD:
                    large[g] = True
                    yield from met(around, np.sort(some), side, labels, (*used, k))
        keep = np.repeat((size > 1) & ~large, size)
        yield from connected(around, rows[order[keep]], np.repeat(np.arange(len(start)), size)[keep], labels)


def reaching(around: np.ndarray, rows: np.ndarray, side: int) -> np.ndarray:
    """Rows whose text goes SPAN / 2 shingles to this side of the middle."""
    return rows[around[rows, SPAN - 1 + side * (SPAN // 2)] > 0]


def shifted(around: np.ndarray, rows: np.ndarray, side: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Rows, and for six pairs of neighbours others, where those begin that a row may agree with if places shift, and how many they are.

    As in met(), six pairs are whole; each of a pair's two bytes may be found up to SHIFT places away, so that a row's
    pair meets all 25 such pairs of the others. The outer six are taken, or those with the fewest candidates if these
    have many.
    """
    seekers, moves = reaching(around, rows, side), range(-SHIFT, SHIFT + 1)

    def candidates(k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        value = np.concatenate([far_pair(around, rows, side, k, s, t) for s in moves for t in moves if s or t])
        order = np.argsort(value, kind="stable")
        own, value = far_pair(around, seekers, side, k), value[order]
        lo = np.searchsorted(value, own)
        return np.tile(rows, (2 * SHIFT + 1) ** 2 - 1)[order], lo, np.searchsorted(value, own, side="right") - lo

    found = [candidates(k) for k in range(PAIRS - NEEDED, PAIRS)]
    if any(int(n.sum()) > 64 * len(rows) for _, _, n in found):
        found += [candidates(k) for k in range(PAIRS - NEEDED)]
        found = sorted(found, key=lambda x: int(x[2].sum()))[:NEEDED]
    return seekers, found


def frequent(around: np.ndarray, rows: np.ndarray, labels: Labels) -> Iterator[np.ndarray]:
    """Links among many rows of a key that connect all that agree. Of rows of equal bytes one stands for all.

    As few links connect large components, rows are also linked with NEXT others that are most like them to either side,
    so that their spans are wide.
    """
    _, first, equal = np.unique(around[rows], axis=0, return_index=True, return_inverse=True)
    order = np.argsort(equal.reshape(-1), kind="stable")
    yield from connected(around, rows[order], equal.reshape(-1)[order], labels)
    rows = rows[np.sort(first)]
    apart = {side: shifted(around, rows, side) for side in (1, -1)}
    if sum(int(n.sum()) for _, found in apart.values() for _, _, n in found) > len(rows) ** 2 // 2:  # as in texts of few words
        yield from connected(around, rows, np.zeros(len(rows), "i8"), labels)
    else:
        for side in (1, -1):
            yield from met(around, reaching(around, rows, side), side, labels)
        for seekers, found in apart.values():
            for others, begin, n in found:
                yield from compared(around, seekers, others, begin, n, labels)
    for side, half in ((1, slice(SPAN - 1, 2 * SPAN - 1)), (-1, slice(SPAN - 1, None, -1))):
        rows = rows[np.argsort(np.ascontiguousarray(around[rows, half]).view(f"S{SPAN}").reshape(-1), kind="stable")]
        rows = rows[np.argsort(labels.of[rows], kind="stable")]
        for step in range(1, NEXT + 1):
            same = labels.of[rows[:-step]] == labels.of[rows[step:]]
            x, y = rows[:-step][same], rows[step:][same]
            for at in range(0, len(x), COMPARED):
                a, b = x[at : at + COMPARED], y[at : at + COMPARED]
                ok, first, last = either_way(around, a, b)
                yield np.column_stack([a, b, first, last])[ok]


def exact_spans(around: np.ndarray, rows: np.ndarray, key: np.ndarray, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each of the SPAN stretches around the middle: (rows, partners, first shingle), rows that are exactly like another text's there."""
    width = 2 * SPAN - 1
    base = int(M1)
    power = np.array([pow(base, k, 1 << 64) for k in range(width)], "u8")
    back = np.array([pow(base, -k, 1 << 64) for k in range(SPAN)], "u8")
    hashes, whole = np.empty((len(rows), SPAN), "u8"), np.empty((len(rows), SPAN), bool)
    for k in range(0, len(rows), 4096):
        own = around[rows[k : k + 4096]]
        total = np.zeros((len(own), width + 1), "u8")
        np.cumsum(own * power, axis=1, dtype="u8", out=total[:, 1:])
        hashes[k : k + 4096] = (total[:, SPAN:] - total[:, :SPAN]) * back
        gaps = np.zeros((len(own), width + 1), "i2")
        np.cumsum(own == 0, axis=1, dtype="i2", out=gaps[:, 1:])
        whole[k : k + 4096] = gaps[:, SPAN:] == gaps[:, :SPAN]
    for k in range(SPAN):
        some = np.flatnonzero(whole[:, k])
        v, t = (hashes[some, k] ^ key[rows[some]].view("u8")) * M2, text[rows[some]]
        order = np.argsort(v, kind="stable")
        v = v[order]
        again = np.zeros(len(v), bool)
        again[1:] = v[1:] == v[:-1]
        again[:-1] |= again[1:]
        order, v = order[again], v[again]
        order = order[np.lexsort((t[order], v))]
        v = hashes[some[order], k] ^ key[rows[some[order]]].view("u8")
        if not len(v):
            continue
        start = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(v))))
        least, most = order[start][group], order[np.append(start[1:], len(v)) - 1][group]
        partner = np.where(t[order] != t[least], least, most)
        other = t[order] != t[partner]
        yield rows[some[order[other]]], rows[some[partner[other]]], k


def linked(table: pa.Table) -> pa.Table:
    """Links (text_a, start_a, end_a, text_b, start_b, end_b) in words that connect, for each key, all that agree; ends are beyond.

    Rows without a text_b are further places of linked windows.
    """
    table = table.sort_by([("key", "ascending"), ("text", "ascending"), ("at", "ascending")])
    key, text, at = (table[c].to_numpy() for c in ("key", "text", "at"))
    width = 2 * SPAN - 1
    around = np.zeros((len(key), WIDE), "u1")
    around[:, :width] = np.frombuffer(b"".join(table["around"].to_pylist()), "u1").reshape(len(key), width)
    pairs: list[np.ndarray] = []
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(first, len(key)))
    leader = np.repeat(first, sizes)
    reached = leader == np.arange(len(key))
    rest = np.flatnonzero(~reached)
    whole = reached.copy()  # agrees with the first of its key as far as its bytes go
    for k in range(0, len(rest), 4096):  # each window with the first of its key
        some = rest[k : k + 4096]
        ok, lo, hi = either_way(around, leader[some], some)
        pairs.append(np.column_stack([leader[some], some, lo, hi])[ok])
        reached[some[ok]] = True
        whole[some] = ok & (lo == 0) & (hi == 2 * SPAN - 2)
    # keys whose windows aren't all like the first; that one was compared with all
    labels = Labels(np.where(reached, leader, np.arange(len(key))))
    open_ = np.isin(leader, leader[~reached]) & (leader != np.arange(len(key)))
    many = open_ & (np.repeat(sizes, sizes) > MANY)
    few = np.flatnonzero(open_ & ~many)
    pairs += connected(around, few, leader[few], labels)
    for g in np.unique(leader[many]):
        pairs += frequent(around, np.arange(g + 1, g + sizes[first.searchsorted(g)]), labels)
    p = np.concatenate(pairs) if pairs else np.zeros((0, 4), "i8")
    p = p[text[p[:, 0]] != text[p[:, 1]]]
    # what each window has of others so far, as one stretch, as all of them hold its middle
    lo, hi = np.full(len(key), 2 * SPAN), np.full(len(key), -1)
    for side in (0, 1):
        np.minimum.at(lo, p[:, side], p[:, 2])
        np.maximum.at(hi, p[:, side], p[:, 3])
    seek = np.flatnonzero((np.repeat(sizes, sizes) > 2) & ~(whole & (lo == 0) & (hi == 2 * SPAN - 2)))
    seen = np.isin(leader, leader[seek])
    wider = []
    for rows, partners, k in exact_spans(around[:, :width], np.flatnonzero(seen), key, text) if len(seek) else ():
        new = (k < lo[rows]) | (k + SPAN - 1 > hi[rows])
        if new.any():
            rows, partners = rows[new], partners[new]
            wider.append(np.column_stack([partners, rows, np.full(len(rows), k), np.full(len(rows), k + SPAN - 1)]))
            np.minimum.at(lo, rows, k)
            np.maximum.at(hi, rows, k + SPAN - 1)
    p = np.concatenate([p, *wider])
    a, b = p[:, 0], p[:, 1]
    start = lambda x, lo: at[x] - (SPAN - 1) + lo
    end = lambda x, hi: at[x] - (SPAN - 1) + hi + SHINGLE
    columns = {"text_a": text[a], "start_a": start(a, p[:, 2]), "end_a": end(a, p[:, 3]), "text_b": text[b], "start_b": start(b, p[:, 2]), "end_b": end(b, p[:, 3])}
    out = pa.table({name: pa.array(x, pa.int64()) for name, x in columns.items()})
    again = [(r, np.frombuffer(m, "<u4").astype("i8")) for r, m in enumerate(table["more"].to_pylist()) if m and hi[r] >= 0]
    if again:
        rows = np.repeat([r for r, _ in again], [len(m) for _, m in again])
        shift = np.concatenate([m for _, m in again]) - at[rows]
        none = pa.nulls(len(rows), pa.int64())
        others = [pa.array(text[rows]), pa.array(start(rows, lo[rows]) + shift), pa.array(end(rows, hi[rows]) + shift), none, none, none]
        out = pa.concat_tables([out, pa.table(others, schema=out.schema)])
    return out


LINKED = "text_a long, start_a long, end_a long, text_b long, start_b long, end_b long"


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit_bytes: int = UNIT_BYTES, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, held: int = HELD, local: int = LOCAL, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(links, info): verified links between texts, by their hashes, and (doc_id, text_hash, words) of all rows."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets, blocks = max(1, -(-size // bucket_bytes)), max(1, -(-size // block_bytes))
    coarse = min(buckets, fan)
    out = checkpointed(rows.mapInArrow(lambda it: sent(it, buckets, coarse, unit_bytes, local), SENT))
    info = out.where("bucket IS NULL").select("doc_id", "text_hash", "words")
    sets = out.where("bucket IS NOT NULL").select("bucket", "unit", "keys", "docs", "at")
    if coarse < buckets:
        groups = max(1, size // unit_bytes // fan)
        fine = sets.where("bucket >= 0").groupBy("bucket", F.pmod(F.xxhash64("unit"), F.lit(groups))).applyInArrow(lambda t: recut(t, buckets), PACKETS)
        sets = fine.unionByName(sets.where("bucket < 0"))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")
    wanted = checkpointed(sets.groupBy("bucket").applyInArrow(shared_keys, "key long, doc_id long, text_hash long, at long, n long, away boolean").withColumn("block", block))
    away = wanted.where("away").select("key").distinct()
    if not away.isEmpty():  # keys whose windows came by several ways are counted anew
        few = lambda df: F.broadcast(df) if df.count() <= MOST_KEYS else df
        counted = wanted.join(few(away), "key", "left_semi").groupBy("key").agg(F.count("*").alias("all"))
        wanted = wanted.join(few(checkpointed(counted)), "key", "left").withColumn("n", F.coalesce("all", "n")).drop("all")
    texts = rows.where(F.octet_length("text") > LEAST_WORDS).withColumn("block", block).repartition(shuffle_partitions(spark), "block")
    windows = texts.groupBy("block").cogroup(wanted.drop("away").groupBy("block")).applyInArrow(surroundings, "key long, text long, at long, n long, around binary, more binary")
    groups = max(1, -(-wanted.count() // held))
    # keys of too many windows: a window goes to a task for each pair of its salt and another
    salts = F.ceil(F.col("n") / held)
    own = F.pmod(F.xxhash64("text", "at"), salts)
    others = F.filter(F.sequence(F.lit(0).cast("long"), salts - 1), lambda k: k != own)
    dealt = windows.withColumn("pair", F.explode(F.when(F.col("n") > held, F.transform(others, lambda k: F.least(k, own) * salts + F.greatest(k, own))).otherwise(F.array(F.lit(-1).cast("long")))))
    dealt = dealt.withColumn("group", F.when(F.col("n") > held, F.xxhash64("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(groups))))
    links = dealt.groupBy("group", "pair").applyInArrow(linked, LINKED)
    return links, info


def merged(spans: DataFrame) -> DataFrame:
    """(text, passages): sorted spans (text, start, end) of each text, those that touch made one."""
    order = Window.partitionBy("text").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    x = spans.withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int")).withColumn("island", F.sum("new").over(order))
    x = x.groupBy("text", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return x.groupBy("text").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("passages"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies, passages) for each row of docs.

    class_id: the least id of the documents linked with it, itself included. n_links: different texts that it is
    linked with (the links that connect its class and some for spans, not all texts that are alike). n_copies: rows of
    equal text, itself included. passages: repeated stretches, in words from 0, ends beyond, merged where they touch (a
    copy's whole text is one if it has 50 words).
    """
    links, info = passages(docs, id_col, text_col, **parameters)
    links = checkpointed(links)
    texts = checkpointed(info.groupBy("text_hash").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"), F.max("words").alias("words")))
    sides = links.select(F.col("text_a").alias("text"), F.col("start_a").alias("start"), F.col("end_a").alias("end"), F.col("text_b").alias("other")).unionByName(
        links.where("text_b IS NOT NULL").select(F.col("text_b").alias("text"), F.col("start_b").alias("start"), F.col("end_b").alias("end"), F.col("text_a").alias("other"))
    )
    found = components(links.where("text_b IS NOT NULL").select(F.col("text_a").alias("a"), F.col("text_b").alias("b")))
    # a component's class is the least id of all its texts
    found = found.join(texts, found.node == texts.text_hash).select("node", "component", "rep")
    found = found.join(found.groupBy("component").agg(F.min("rep").alias("class")), "component").select("node", "class")
    n_links = sides.where("other IS NOT NULL").select("text", "other").distinct().groupBy("text").agg(F.count("*").alias("n_links"))
    per = merged(sides.select("text", "start", "end").distinct()).join(n_links, "text").join(found, F.col("text") == found.node)
    whole = F.struct(F.lit(0).cast("long").alias("start"), F.col("words").alias("end"))
    x = texts.join(per, texts.text_hash == per.text, "left")
    copied = (F.col("n_copies") > 1) & (F.col("words") >= LEAST_WORDS)
    none = F.filter(F.array(whole), lambda s: F.lit(False))
    x = x.select("text_hash", F.coalesce("class", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies", copied.alias("copied"), F.when(copied, F.array(whole)).otherwise(F.coalesce("passages", none)).alias("passages"))
    out = info.join(x, "text_hash")
    # copies too short to be passages stay alone
    own = F.when(F.col("copied") | (F.size("passages") > 0), F.col("class_id")).otherwise(F.col("doc_id"))
    named = lambda c: F.when(c != NO_ID, c)
    return out.select(named(F.col("doc_id")).alias("doc_id"), named(own).alias("class_id"), "n_links", "n_copies", "passages")


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spread(documents(spark, sf_dir).select("doc_id", "text")))
