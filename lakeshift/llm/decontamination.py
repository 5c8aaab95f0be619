"""Benchmark decontamination with DataFrame functions only: canonical templates, windows, slot consistency.

Texts become templates: tokens with a digit are <n>, words after a number from a list of units <u>, capitalised words
inside a sentence (not those all in capitals) <p>; the rest is lower-cased and loses punctuation. Windows of ``window`` tokens of benchmark items
with enough literal tokens are hash-joined with all windows of all documents. A document and an item whose shared
windows cover ``min_windows`` different windows of the item (or all, if it has fewer) are a match if the slots are
consistent: under the matched windows, one value in the item always stands for one value in the document, or does so in
one occurrence with enough windows, as a document may hold an item twice with different values. No conflict is
tolerated. So an item with other numbers, names or units is found, and text that only looks alike is not.

Verbatim copies don't depend on templates: windows of the lower-cased tokens themselves are joined as well, so that
items of many numbers or names, and names in other case or place, are found. The first token of an item is compared as
it stands and as a name. An item with fewer tokens than a window is one window as a whole, and matches wherever it
stands; with fewer than ``least_tokens`` it has no template, only its literal window.

Items of equal template are one class, under their least id. The benchmark's windows are broadcast only if a count
shows that they are few, by their anchors (a window's two neighbours of the most letters): a document's window is only hashed where it has
the anchor of one. Beyond ``broadcast_rows`` all windows of both sides are shuffled. Both ways find the same.

Nulls and empty texts have no windows and match nothing; nor do items without a token. Repeated rows give one match,
however many they are (hits are made distinct before they are grouped); a null id is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeshift.llm.common import checkpointed, documents, spread

WINDOW, MIN_WINDOWS, LEAST_TOKENS, LITERALS, BROADCAST_ROWS = 8, 6, 6, 5, 200_000
#: Words that an occurrence may have more or less between two hits.
GAP = 3
UNITS = "mm|cm|m|km|in|inch|inches|ft|feet|foot|yd|yards?|miles?|mg|g|kg|lb|lbs|pounds?|oz|ounces?|tons?|ml|l|liters?|litres?|gallons?|s|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|mph|kmh|percent|dollars?|cents?|euros?|usd|eur|degrees?"
SPACE = r"[\x20\x09-\x0D]"
MARK = "⟨"  # opens a placeholder; texts lose theirs


PUNCTUATION = ".,;:!?\"()[]|"


def one_spaced(text: Column) -> Column:
    """The text without marks, white space made single spaces."""
    return F.regexp_replace(F.replace(text, F.lit(MARK), F.lit("")), rf"[\x09-\x0D]{SPACE}*|\x20{SPACE}+", " ")


def with_numbers(x: Column, values: bool = False) -> Column:
    """Placeholders for numbers and units in a one-spaced text."""
    kept = "$0" if values else ""
    numbers = F.regexp_replace(x, r"(?<!\S)\S*[0-9]\p{L}*", f"{MARK}n⟩{kept}")
    numbers = F.regexp_replace(numbers, rf"(?<=[0-9⟩\p{{L}}]{SPACE})(?<={MARK}n⟩\S{{0,40}}{SPACE})(?i:{UNITS})(?!\p{{L}})", f"{MARK}u⟩{kept}")
    return F.when(x.rlike("[0-9]"), numbers).otherwise(x)


def with_names(x: Column, values: bool = False) -> Column:
    return F.regexp_replace(x, r"\p{Lu}(?<=[^.!?:;\s]\x20.)[\p{Ll}\p{M}'’-]+(?!\p{L})", f"{MARK}p⟩{'$0' if values else ''}")


def words_of(x: Column) -> Column:
    """Lower-case tokens without punctuation."""
    return F.array_remove(F.split(F.translate(F.lower(x), PUNCTUATION, ""), " "), "")


def template(text: Column, values: bool = False) -> Column:
    """The text's template as tokens; with values, each placeholder is followed by what it stands for (of one token)."""
    x = one_spaced(text)
    return words_of(with_names(with_numbers(x, values), values))


def literal(text: Column) -> Column:
    """The text's tokens without templates."""
    return words_of(one_spaced(text))


def tokenized(rows: DataFrame) -> DataFrame:
    """rows (id, rk, text) as (id, rk, ts, ls): tokens of the template and of the literal text.

    The steps are columns of their own, so that each is evaluated once.
    """
    x = rows.where(F.octet_length("text") > 0).select("id", "rk", one_spaced(F.col("text")).alias("x"))
    x = x.select("id", "rk", "x", with_numbers(F.col("x")).alias("y"))
    return x.select("id", "rk", words_of(with_names(F.col("y"))).alias("ts"), words_of(F.col("x")).alias("ls"))


def window_hash(words: Column, at: Column, length: Column) -> Column:
    return F.xxhash64(F.slice(words, at + 1, length))


def windows(words: Column, length: Column) -> Column:
    """A hash of each window of the tokens."""
    n = F.size(words) - length
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: window_hash(words, i, length))).otherwise(F.array().cast("array<bigint>"))


def anchor(words: Column, at: Column, length: Column) -> Column:
    """Of a window's pairs of neighbours, that of the most letters: (n, i, h), its place i and its hash h.

    Placeholders have none. A window of one token has its hash alone.
    """
    own, size = F.slice(words, at + 1, length), lambda t: F.when(t.startswith(MARK), 0).otherwise(F.length(t))
    pairs = F.transform(F.slice(own, 1, F.greatest(length - 1, F.lit(1))), lambda t, i: F.struct((-size(t) - F.coalesce(size(F.get(own, i + 1)), F.lit(0))).alias("n"), i.alias("i"), F.xxhash64(t, F.get(own, i + 1)).alias("h")))
    return F.array_min(pairs)


def item_windows(bench: DataFrame, window: int, least: int, literals: int) -> DataFrame:
    """(item, n_items, unit, len, at, w, c, a, slots, n_windows, tagged): windows of each class of items.

    unit: 0 for templates, else a literal text of the class, whose lengths are negative. c: the window that w stands for.
    a: the anchor of w.
    """
    all_ = bench.select("item_id", "text").where(F.col("text").isNotNull()).withColumn("t", template(F.col("text"))).withColumn("template", F.array_join("t", " "))
    all_ = checkpointed(all_)
    x = all_.groupBy("template").agg(F.min_by(F.struct("item_id", "text"), F.struct(F.col("item_id").isNull(), "item_id", "text")).alias("i"), F.count("*").alias("n_items"))
    x = x.select("template", F.col("i.item_id").alias("item"), F.col("i.text").alias("text"), "n_items", F.array_remove(F.split("template", " "), "").alias("t"))
    columns = ["item", "n_items", "unit", "len", "at", "w", "c", "a", "slots", "tagged"]
    texts = all_.select("template", literal(F.col("text")).alias("t")).distinct().join(x.select("template", "item", "n_items"), "template").where(F.size("t") > 0)
    texts = texts.withColumn("n", F.least(F.size("t"), F.lit(window))).withColumn("unit", F.xxhash64("t").bitwiseOR(F.lit(1).cast("long"))).withColumn("len", -F.col("n"))
    texts = texts.select("*", F.posexplode(windows(F.col("t"), F.col("n"))).alias("at", "w"))
    texts = texts.withColumn("c", F.col("w")).withColumn("a", anchor(F.col("t"), F.col("at"), F.col("n"))).withColumn("slots", F.lit(0)).withColumn("tagged", F.lit(None).cast("array<string>"))
    x = x.where(F.size("t") >= least).withColumn("len", F.least(F.size("t"), F.lit(window)))
    # inside a line, the first word may look like a name
    inside = template(F.concat(F.lit("a "), F.regexp_replace("text", f"^{SPACE}+", "")))
    x = x.withColumn("other", F.slice(inside, 2, F.greatest(F.size(inside), F.lit(1)))).withColumn("tagged", template(F.col("text"), True))
    e = x.select("*", F.lit(0).cast("long").alias("unit"), F.posexplode(windows(F.col("t"), F.col("len"))).alias("at", "c"))
    slots = F.aggregate(F.transform(F.slice("t", F.col("at") + 1, F.col("len")), lambda t: t.startswith(MARK).cast("int")), F.lit(0), lambda a, m: a + m)
    e = e.withColumn("slots", slots).where(F.col("len") - F.col("slots") >= F.least(F.lit(literals), F.col("len") - 1))
    entry = lambda words: F.struct(window_hash(words, F.col("at"), F.col("len")).alias("w"), anchor(words, F.col("at"), F.col("len")).alias("a"))
    own, other = entry(F.col("t")), entry(F.col("other"))
    both = F.when((F.col("at") == 0) & (F.size("other") >= F.col("len")), F.array_distinct(F.array(own, other))).otherwise(F.array(own))
    e = e.withColumn("e", F.explode(both)).withColumn("w", F.col("e.w")).withColumn("a", F.col("e.a")).select(*columns).unionByName(texts.select(*columns))
    per = e.groupBy("item", "unit").agg(F.countDistinct("c").alias("n_windows"))
    return e.join(per, ["item", "unit"])


def at_anchors(x: DataFrame, index: DataFrame, anchor: Column) -> DataFrame:
    """Where rows (id, rk, n, both, p: a place in both, of which the first n are the template) have windows of the index, by their anchors."""
    start, length, of_template = F.col("p") - F.col("offset"), F.abs("len"), F.col("len") > 0
    inside = F.when(of_template, (start >= 0) & (start + length <= F.col("n"))).otherwise((start >= F.col("n")) & (start + length <= F.size("both")))
    same = window_hash(F.col("both"), F.greatest(start, F.lit(0)), length) == F.col("w")
    found = x.withColumn("_anchor", anchor).drop("token").join(F.broadcast(index), (F.col("_anchor") == F.col("anchor")) & inside & same)
    return found.withColumn("pos", start - F.when(of_template, 0).otherwise(F.col("n")))


def window_hits(rows: DataFrame, items: DataFrame, few: bool) -> DataFrame:
    """(id, rk, item, unit, len, at, pos, slots, c): windows of the items found in the rows (id, rk, text), each once.

    If the items are few, their anchors are broadcast, and a window is only made where a document has its anchor. Else
    the windows of both sides meet in a shuffle.
    """
    index = items.select("item", "unit", "len", "at", "w", "c", "slots", F.col("a.i").alias("offset"), F.col("a.h").alias("anchor"))
    texts = tokenized(rows)
    if few:
        # at each token, the pair of it and the next; windows of one token are rare and have a pass of their own
        x = texts.select("id", "rk", F.size("ts").alias("n"), F.concat("ts", "ls").alias("both"))
        # outer: else a filter for arrays that aren't empty is inferred, which makes all templates once more
        x = x.select("*", F.posexplode_outer("both").alias("p", "token"))
        one = F.abs("len") == 1
        found = at_anchors(x, index.where(~one), F.xxhash64("token", F.get("both", F.col("p") + 1)))
        if not items.where(one).isEmpty():
            found = found.unionByName(at_anchors(x, index.where(one), F.xxhash64("token", F.lit(None).cast("string"))))
    else:
        lengths = [r[0] for r in items.select("len").distinct().collect()]  # at most `window` lengths of either kind
        placed = lambda k: F.transform(windows(F.col("ts" if k > 0 else "ls"), F.lit(abs(k))), lambda w, i: F.struct(F.lit(k).alias("len"), i.alias("pos"), w.alias("w")))
        found = texts.select("id", "rk", F.inline_outer(F.concat(*map(placed, lengths or [1])))).join(index, ["len", "w"])
    return found.select("id", "rk", "item", "unit", "len", "at", "pos", "slots", "c").distinct()


def matches(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, min_windows: int = MIN_WINDOWS, least_tokens: int = LEAST_TOKENS, literals: int = LITERALS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(id, rk, item_id, n_items, n_windows, item_windows, first_token, n_slots, n_conflicts): what is contaminated."""
    rk = F.xxhash64(F.col(id_col).isNull(), F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), rk.alias("rk"), F.col(text_col).alias("text"))
    items = checkpointed(item_windows(bench, window, least_tokens, literals))
    few = items.count() <= broadcast_rows
    hits = checkpointed(window_hits(rows, items, few))
    per = hits.groupBy("id", "rk", "item", "unit").agg(F.countDistinct("c").alias("n_windows"), F.min("pos").alias("first_token"), F.max("slots").alias("most_slots"))
    of_item = items.groupBy("item", "unit").agg(F.first("n_windows").alias("item_windows"), F.first("n_items").alias("n_items"))
    of_item = F.broadcast(of_item) if few else of_item
    per = checkpointed(per.join(of_item, ["item", "unit"]).where(F.col("n_windows") >= F.least(F.lit(min_windows), F.col("item_windows"))))
    plain = per.where(F.col("most_slots") == 0).withColumn("n_slots", F.lit(0)).withColumn("n_conflicts", F.lit(0))
    slotted = per.where(F.col("most_slots") > 0)
    if not slotted.isEmpty():
        plain = plain.unionByName(consistent(rows, slotted, hits, items, min_windows))
    told = ["n_items", "n_windows", "item_windows", "first_token", "n_slots", "n_conflicts"]
    one = plain.groupBy("id", "rk", "item").agg(F.min_by(F.struct(*told), F.struct(F.col("unit") != 0, "unit")).alias("one"))  # by its template if it can
    return one.select("id", "rk", F.col("item").alias("item_id"), *(F.col(f"one.{c}").alias(c) for c in told))


def decontaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of docs that hold no passage of the benchmark."""
    found = matches(docs, bench, id_col, text_col, **parameters).select(F.col("id").alias("_id"), F.col("rk").alias("_rk")).distinct().hint("shuffle_hash")
    rk = F.xxhash64(F.col(id_col).isNull(), F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.withColumn("_row", rk)
    return rows.join(found, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_rk")), "left_anti").drop("_row")


def consistent(rows: DataFrame, slotted: DataFrame, hits: DataFrame, items: DataFrame, min_windows: int) -> DataFrame:
    """Of the matches with placeholders, those whose slots have one value for each in the item, in the whole document or in one occurrence."""
    same = lambda a, b: F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.rk") == F.col(f"{b}.rk"))
    wanted = slotted.select("id", "rk").distinct()
    texts = rows.alias("r").join(wanted.alias("w").hint("shuffle_hash"), same("r", "w"), "left_semi").dropDuplicates(["id", "rk"]).select("id", "rk", template(F.col("text"), True).alias("t"))
    own = ["id", "rk", "item"]
    x = hits.where("unit = 0").alias("h").join(slotted.alias("s"), same("h", "s") & (F.col("h.item") == F.col("s.item"))).select("h.id", "h.rk", "h.item", "h.at", "h.pos", "h.len", "h.c", "h.slots", F.least(F.lit(min_windows), "s.item_windows").alias("need"), (F.col("h.pos") - F.col("h.at")).alias("shift"))
    # hits of one occurrence lie at one distance, or at some that hardly differ where words are missing or new
    new = F.coalesce(F.col("shift") - F.lag("shift").over(Window.partitionBy(*own).orderBy("shift")) > GAP, F.lit(True))
    x = x.withColumn("run", F.sum(new.cast("int")).over(Window.partitionBy(*own).orderBy("shift")))
    of = lambda kind, place: F.struct(F.lit(kind).alias("kind"), place.cast("long").alias("place"))
    x = x.withColumn("of", F.explode(F.array(of(0, F.lit(0)), of(1, F.col("run")), of(2, F.col("shift")))))
    at = x.groupBy(*own, "of").agg(F.collect_set(F.when(F.col("slots") > 0, F.struct("at", "pos", "len"))).alias("at"), F.countDistinct("c").alias("n"), F.first("need").alias("need")).where((F.col("of.kind") == 0) | (F.col("n") >= F.col("need")))
    tagged = items.where("unit = 0").groupBy("item").agg(F.first("tagged").alias("tagged"))
    x = at.alias("a").join(texts.alias("x"), same("a", "x")).select("a.id", "a.rk", "a.item", "a.of", "a.at", "x.t").join(tagged, "item")
    pairs = F.array_distinct(F.flatten(F.transform("at", lambda m: F.filter(
        F.transform(F.sequence(F.lit(0), m["len"] - 1), lambda k: F.struct(F.get("tagged", m["at"] + k).alias("i"), F.get("t", m["pos"] + k).alias("d"))),
        lambda p: p["i"].startswith(MARK)))))
    x = x.select(*own, "of", pairs.alias("p"))
    x = x.withColumn("n_slots", F.size(F.array_distinct(F.transform("p", lambda p: p["i"])))).withColumn("n_conflicts", F.size("p") - F.col("n_slots"))
    x = x.where("n_conflicts = 0").groupBy(*own).agg(F.min_by(F.struct("n_slots", "n_conflicts"), "of").alias("best"))
    return slotted.alias("s").join(x.alias("x"), same("s", "x") & (F.col("s.item") == F.col("x.item"))).select("s.*", "x.best.n_slots", "x.best.n_conflicts")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item (class) of which it holds a passage."""
    found = matches(spread(documents(spark, sf_dir).select("doc_id", "text")), documents(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "n_items", "n_windows", "item_windows", "first_token", F.col("n_slots").cast("long").alias("n_slots"), F.col("n_conflicts").cast("long").alias("n_conflicts"))
