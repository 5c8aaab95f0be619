"""Chat formatting: a hidden Markov model recovers the roles of a transcript's lines, then turns are rendered.

A transcript is raw text in which speakers are marked in any of several ways, or not at all. States are a role and
whether the line opens a turn. A line's observations are the speaker marker at its start (a known word in brackets,
before a colon, or alone), its length, whether it ends in a question mark, whether a blank line precedes it, and whether
it is the first of all. Start, transition and emission probabilities are estimated by counting over labelled
conversations (add-1/2). Viterbi finds the best path; each turn is then rendered as

    <|im_start|>role
    text<|im_end|>

A marker is taken off only where the path opens a turn with the marker's role; it comes back as a column, and all other
lines stay as they are, but for blank lines at a turn's end (n_lines counts them). So the transcript can be rebuilt.

Long conversations are cut in stretches of ``stretch`` turns by their number, and stretches of more than ``most`` rows
(many null or equal turn numbers) further, by the number and a hash of the line. Whether a stretch is the first, and
whether a blank line precedes it, comes with its rows, in training too. For each stretch, the best scores from each
state before to each state at the end (a matrix) come first; they are chained over the conversation (some hundred bytes
a stretch); then each stretch finds its path between the states known at both ends. The result is that of one run. A
turn that goes on across such a border comes as two rows, the second with ``continues``; the first isn't closed.

Nulls: a null text is an empty line, a null turn comes first, a null conversation is one of its own. Lines of equal
turn come in the order of a hash of their text. Repeated rows are lines of their own (and lie in one stretch). Roles other than the three teach nothing. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeshift.llm.common import ASCII_SPACE, checkpointed, documents, shuffle_partitions, small_batches

ROLES = ("user", "assistant", "system")
#: Words that name a speaker.
SPEAKERS = {
    "user": ("user", "human", "customer", "q", "question", "prompt", "instruction", "utilisateur", "benutzer", "usuario"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "response", "gpt", "model", "agent", "assistent", "asistente"),
    "system": ("system", "note", "context", "sistema", "système"),
}
ROLE_OF = {w: r for r, (_, words) in enumerate(SPEAKERS.items()) for w in words}
_WORDS = "|".join(sorted(ROLE_OF, key=len, reverse=True))
MARKER = re.compile(rf"\s*(?:[\[<(*#]+\|?\s*(?P<a>{_WORDS})\s*(?:\|?[\]>)*]+:?|:[\])*]*|$)|(?P<b>{_WORDS})\s*:)\s*", re.IGNORECASE)
STATES = 2 * len(ROLES)  # role * 2 + (0: opens a turn, 1: goes on)
#: Sizes of the observations: marker, length, question, blank before, first.
SIZES = (4, 6, 2, 2, 2)
STRETCH, MOST = 256, 4096
#: How many pieces a stretch may be cut in.
PIECES = 1 << 30
NO_ID = -(2**63)
ROWS = "conv long, stretch long, seq long, role string, raw string"
TURNS = "conv_id long, turn long, line long, role string, continues boolean, n_lines long, text string, marker string"


def observed(line: str, blank: bool, first: bool) -> tuple[tuple[int, ...], int]:
    """A line's observations, and where its marker ends."""
    m = MARKER.match(line)
    rest = line[m.end() :] if m else line
    marker = 1 + ROLE_OF[(m["a"] or m["b"]).lower()] if m else 0
    return (marker, min(5, len(rest).bit_length() // 2), int(rest.rstrip().endswith("?")), int(blank), int(first)), m.end() if m else 0


def lines_of(raw: str | None) -> list[str]:
    return (raw or "").split("\n")


class Model:
    """Log probabilities; counts: (kind, i, j, n) with kinds start (j), move (i to j), line (role i, j: opens or goes on) and f0..f4 (state i, value j)."""

    def __init__(self, counts: list[tuple[str, int, int, int]]):
        start, move, goes = np.full(3, 0.5), np.full((3, 3), 0.5), np.full((3, 2), 0.5)
        see = [np.full((STATES, n), 0.5) for n in SIZES]
        for kind, i, j, n in counts:
            if kind == "start":
                start[j] += n
            elif kind == "move":
                move[i, j] += n
            elif kind == "line":
                goes[i, j] += n
            else:
                see[int(kind[1])][i, j] += n
        norm = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
        move, ends = norm(move), norm(goes)
        self.start = np.full(STATES, -np.inf)
        self.start[0::2] = norm(start)
        self.step = np.full((STATES, STATES), -np.inf)
        for r in range(3):
            for before in (2 * r, 2 * r + 1):
                self.step[before, 2 * r + 1] = ends[r, 1]
                self.step[before, 0::2] = ends[r, 0] + move[r]
        self.see = [norm(x).T for x in see]  # value by state

    def emission(self, seen: tuple[int, ...]) -> np.ndarray:
        return sum(table[v] for table, v in zip(self.see, seen, strict=True))

    def reach(self, seen: list[tuple[int, ...]], first: bool) -> tuple[np.ndarray, np.ndarray]:
        """Best scores from each state before (any row if first) to each state at the last line, and the first states on these ways."""
        best, at, opens = None, np.arange(STATES), np.repeat(np.arange(STATES)[None, :], STATES, axis=0)
        for x in seen:
            if best is None:
                best = np.repeat(self.start[None, :], STATES, axis=0) if first else self.step.copy()
            else:
                to = best[:, :, None] + self.step[None, :, :]
                by = to.argmax(axis=1)
                best, opens = to.max(axis=1), opens[at[:, None], by]
            best = best + self.emission(x)
        return best, opens

    def path(self, seen: list[tuple[int, ...]], before: int | None, last: int | None) -> list[int]:
        """The best states, after the state ``before`` (None: a start) and with the last one given (None: the best)."""
        back, best = [], None
        for x in seen:
            if best is None:
                best = self.start if before is None else self.step[before]
            else:
                to = best[:, None] + self.step
                back.append(to.argmax(axis=0))
                best = to.max(axis=0)
            best = best + self.emission(x)
        s = int(best.argmax()) if last is None else last
        out = [s]
        for b in reversed(back):
            s = int(b[s])
            out.append(s)
        return out[::-1]


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """(conversation, stretch) and its rows; the input is sorted."""
    rows = (r for b in batches for r in b.to_pylist())
    for key, group in groupby(rows, key=lambda r: (r["conv"], r["stretch"])):
        yield key, list(group)


def seen_in(rows: list[dict]) -> tuple[list[tuple[int, ...]], list[tuple[int, int, str, int]]]:
    """Observations of all lines of a stretch, and the lines: (turn, number in its row, line, where its marker ends)."""
    seen, out, blank, first = [], [], rows[0]["blank"], rows[0]["first"]
    for r in rows:
        for k, line in enumerate(lines_of(r["raw"])):
            x, cut = observed(line, blank, first and not out)
            seen.append(x)
            out.append((r["seq"], k, line, cut))
            blank = not line.strip(ASCII_SPACE)
    return seen, out


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of lines and their observations by the states that the labels give."""
    counts: dict = {}
    for _, rows in stretches(batches):
        seen, _ = seen_in(rows)
        at = 0
        for r in rows:
            n = len(lines_of(r["raw"]))
            if r["role"] in ROLES:
                i = ROLES.index(r["role"])
                counts["line", i, 1] = counts.get(("line", i, 1), 0) + n - 1
                counts["line", i, 0] = counts.get(("line", i, 0), 0) + 1
                for k in range(n):
                    for f, v in enumerate(seen[at + k]):
                        key = (f"f{f}", 2 * i + (k > 0), v)
                        counts[key] = counts.get(key, 0) + 1
            at += n
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()), pa.array([k[2] for k in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["kind", "i", "j", "n"])


def matrices(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for (conv, stretch), rows in stretches(batches):
        best, opens = model.reach(seen_in(rows)[0], rows[0]["first"])
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([stretch], pa.int64()), pa.array([best.tobytes()], pa.binary()), pa.array([opens.astype("u1").tobytes()], pa.binary())], names=["conv", "stretch", "best", "opens"])


def chained(table: pa.Table) -> pa.Table:
    """For each stretch of a conversation, the state before it and at its end on the best path, and whether its last turn goes on in the next."""
    table = table.sort_by("stretch")
    best, back = None, []
    for m in table["best"].to_pylist():
        m = np.frombuffer(m).reshape(STATES, STATES)
        to = m if best is None else best[:, None] + m
        back.append(to.argmax(axis=0))
        best = to.max(axis=0)
    s = int(best.argmax())
    last = []
    for b in reversed(back):
        last.append(s)
        s = int(b[s])
    last = last[::-1]
    opens = [np.frombuffer(x, "u1").reshape(STATES, STATES) for x in table["opens"].to_pylist()]
    goes_on = [bool(o[a, b] % 2) for o, a, b in zip(opens[1:], last[:-1], last[1:], strict=True)]
    return pa.table([table["conv"], table["stretch"], pa.array([None, *last[:-1]], pa.int32()), pa.array(last, pa.int32()), pa.array([*goes_on, False])], names=["conv", "stretch", "before", "last", "goes_on"])


def rendered(role: str, text: str, continues: bool = False, open_: bool = False) -> str:
    return ("" if continues else f"<|im_start|>{role}\n") + text + ("" if open_ else "<|im_end|>")


def turn_of(lines: list[tuple[int, int, str, int]], state: int, marker: int, open_: bool) -> tuple[str, str]:
    """(text, marker) of a turn's lines, the first of them in the state and with the observed marker."""
    texts, mark = [x for _, _, x, _ in lines], ""
    if not state % 2 and marker == 1 + state // 2:
        cut = lines[0][3]
        mark, texts[0] = texts[0][:cut], texts[0][cut:]
        if not texts[0] and len(texts) > 1:  # the marker has a line of its own
            mark, texts = mark + "\n", texts[1:]
    text = "\n".join(texts)
    return (text + "\n" if open_ else text.rstrip("\n")), mark


def parsed(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Turns of each stretch (see TURNS); first, blank, before, last and goes_on are columns of its rows."""
    held: list[tuple] = []

    def full() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True) if held else [[]] * 8, kinds, strict=True)], names=[x.split()[0] for x in TURNS.split(", ")])

    for (conv, _), rows in stretches(batches):
        first, before = rows[0]["first"], rows[0]["before"]
        seen, lines = seen_in(rows)
        states = model.path(seen, None if first else before, rows[0]["last"])
        at = 0
        while at < len(states):
            end = at + 1
            while end < len(states) and states[end] % 2:
                end += 1
            role, continues = ROLES[states[at] // 2], bool(states[at] % 2)
            open_ = end == len(states) and bool(rows[0]["goes_on"])
            text, marker = turn_of(lines[at:end], states[at], seen[at][0], open_)
            held.append((None if conv == NO_ID else conv, lines[at][0], lines[at][1], role, continues, end - at, rendered(role, text, continues, open_), marker))
            at = end
        if len(held) >= 512:
            yield full()
            held.clear()
    yield full()


#: Whether a text's last line is blank.
ENDS_BLANK = r"(?:^|\n)[\x20\x09\x0B\x0C\x0D]*\z"


def bounded(rows: DataFrame, stretch: int = STRETCH, most: int = MOST) -> DataFrame:
    """rows with the order of lines in a stretch (tie), stretches of too many rows being cut."""
    rows = rows.withColumn("tie", F.xxhash64(F.coalesce("raw", F.lit(""))))
    sizes = rows.groupBy("conv", "stretch").agg(F.count("*").alias("n")).where(F.col("n") > most)
    sizes = checkpointed(sizes)
    n_long = sizes.count()
    if not n_long:
        return rows.withColumn("stretch", F.col("stretch") * PIECES)
    x = rows.join(F.broadcast(sizes) if n_long <= 100_000 else sizes, ["conv", "stretch"], "left")
    pieces = F.least(F.ceil(F.col("n") / most), F.lit(PIECES // max(1, stretch))).cast("long")
    # turns by their number, those of one number by ranges of the hash (its high 31 bits, in the hash's order)
    high = F.shiftright("tie", 33) + F.lit(1 << 30)
    piece = F.pmod("seq", F.lit(stretch)) * pieces + F.floor(high * pieces / float(1 << 31)).cast("long")
    return x.withColumn("stretch", F.col("stretch") * PIECES + F.coalesce(piece, F.lit(0))).drop("n")


def bordered(rows: DataFrame) -> DataFrame:
    """rows with first (the stretch is its conversation's first) and blank (a blank line precedes it)."""
    ends = F.max(F.struct("seq", "tie", F.coalesce("raw", F.lit("")).rlike(ENDS_BLANK).alias("b")))["b"]
    before = Window.partitionBy("conv").orderBy("stretch")
    per = rows.groupBy("conv", "stretch").agg(ends.alias("b"))
    per = per.select("conv", "stretch", F.lag("b").over(before).alias("b"))
    per = per.select("conv", "stretch", F.col("b").isNull().alias("first"), F.coalesce("b", F.lit(False)).alias("blank"))
    return rows.join(per, ["conv", "stretch"])


def fit(labelled: DataFrame, stretch: int = STRETCH, most: int = MOST) -> Model:
    """The model of transcripts (conv, stretch, seq, role, raw) whose roles are known: counts over all of them."""
    spark = labelled.sparkSession
    labelled = bounded(labelled, stretch, most)
    order = Window.partitionBy("conv").orderBy("stretch", "seq", "tie", "role")
    known = labelled.where(F.col("role").isin(*ROLES)).drop("raw")
    moves = known.withColumn("before", F.lag("role").over(order)).groupBy("before", "role").count().collect()
    counts = [("start" if m.before is None else "move", 0 if m.before is None else ROLES.index(m.before), ROLES.index(m.role), m["count"]) for m in moves]
    seen = dealt(bordered(labelled), spark).mapInArrow(counted, "kind string, i int, j int, n long").groupBy("kind", "i", "j").agg(F.sum("n").alias("n")).collect()
    return Model(counts + [(r.kind, r.i, r.j, r.n) for r in seen])


def dealt(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """The rows by stretches, in order; lines of equal place and hash are equal."""
    return rows.repartition(shuffle_partitions(spark), "conv", "stretch").sortWithinPartitions("conv", "stretch", "seq", "tie")


def parse(rows: DataFrame, model: Model, stretch: int = STRETCH, most: int = MOST) -> DataFrame:
    """Turns (see TURNS) of transcripts (conv, stretch, seq, raw), where (stretch, seq) is the order of a conversation.

    stretch: the number of turns by which transcripts() cut them.
    """
    spark = rows.sparkSession
    small_batches(spark)
    marked = bordered(bounded(rows, stretch, most))
    long = marked.where("NOT first").select("conv").distinct()
    if long.isEmpty():
        known = marked.withColumn("before", F.lit(None).cast("int")).withColumn("last", F.lit(None).cast("int")).withColumn("goes_on", F.lit(False))
    else:
        part = dealt(marked.join(long, "conv", "left_semi").select("conv", "stretch", "seq", "tie", "raw", "first", "blank"), spark)
        chain = checkpointed(part.mapInArrow(lambda it: matrices(it, model), "conv long, stretch long, best binary, opens binary").groupBy("conv").applyInArrow(chained, "conv long, stretch long, before int, last int, goes_on boolean"))
        known = marked.join(chain, ["conv", "stretch"], "left")
    return dealt(known.select("conv", "stretch", "seq", "tie", "raw", "first", "blank", "before", "last", "goes_on"), spark).mapInArrow(lambda it: parsed(it, model), TURNS)


def transcripts(conversations: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as raw transcripts: (conv, stretch, seq, role, raw).

    A conversation has one of five ways to mark speakers, by a hash of its id; every eighth turn has no marker; in two
    of the ways, turns are set off by a blank line.
    """
    conv = F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID))
    seq = F.coalesce(F.col("turn").cast("long"), F.lit(-1))
    style = F.pmod(F.xxhash64(conv), F.lit(5))
    names = {0: ("User: ", "Assistant: ", "System: "), 1: ("Human: ", "AI: ", "System: "), 2: ("Q: ", "A: ", "Note: "), 3: ("[user] ", "[assistant] ", "[system] "), 4: ("### User\n", "### Assistant\n", "### System\n")}
    marker = F.lit("")
    for s, marks in names.items():
        for r, m in zip(ROLES, marks, strict=True):
            marker = F.when((style == s) & (F.col("role") == r), F.lit(m)).otherwise(marker)
    marker = F.when(F.pmod(F.xxhash64(conv, seq), F.lit(8)) == 0, F.lit("")).otherwise(marker)
    raw = F.concat(marker, F.coalesce(F.col("text"), F.lit("")), F.when(style.isin(1, 4), F.lit("\n")).otherwise(F.lit("")))
    return conversations.select(conv.alias("conv"), F.floor(seq / stretch).cast("long").alias("stretch"), seq.alias("seq"), F.col("role"), raw.alias("raw"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as raw transcripts, parsed by a model of those whose crc32(conv_id) mod 5 is not 0, as rendered turns."""
    rows = transcripts(documents(spark, sf_dir, "conversations"))
    taught = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(5)) != 0
    return parse(rows.drop("role"), fit(rows.where(taught)))
