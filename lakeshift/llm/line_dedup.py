"""Line dedup with DataFrame functions only: range-partitioned hashes, secondary sort, first occurrences streamed.

Each document's lines are keyed, and long enough keys become rows (two hashes, document, position). The rows are
dealt by ranges of the first hash: hashes are uniform, so that equal ranges need no sampling. Within a range they are
sorted by hash, then by document (largest id first) and position, so the first document of each key is the one that
keeps it, and a window function streams over the run. Keys with more rows than a limit (of 1/4096 of all rows, and of
``MOST_ROWS`` however many there are) never meet in one task: their document counts and largest ids are pre-aggregated,
and a broadcast of these few rows decides for each line where it is; if a count shows more than ``MOST_HOT`` of them,
they are joined, each in several copies, so that no key's lines meet in one task there either.

What comes back is, for each document, a run-length coded bitmap of its lines instead of text.

Nulls: a null text is one empty line; a null id is the smallest. Rows of equal id count as one document, and the lines
of the largest id stay in all of its rows. Empty tables give no rows; other columns stay untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeshift.llm.common import ASCII_SPACE, ascii_lower, checkpointed, documents, shuffle_partitions, spread, wide_hash

MIN_CHARS, MIN_DOCS = 20, 3
#: Ranges of the hash, as a power of two.
RANGE_BITS = 13
#: A key is hot if it has more than this share of all rows (so there are at most 4096 hot ones) and HOT_ROWS, or MOST_ROWS.
HOT_SHARE, HOT_ROWS, MOST_ROWS, MOST_HOT, COPIES = 1 / 4096, 64, 1_000_000, 500_000, 64


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, rk, pos, h1, h2) for each line whose key is long enough; docs: (id, rk, text)."""
    lines = docs.select("id", "rk", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    # no line is longer in code points than in bytes
    keys = lines.where(F.octet_length("line") >= min_chars).select("id", "rk", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    h1, h2 = wide_hash(F.col("key"))
    return keys.select("id", "rk", "pos", h1.alias("h1"), h2.alias("h2"))


def with_hot(rows: DataFrame, hot: DataFrame, how: str, few: bool, copies: int = COPIES) -> DataFrame:
    """rows joined with hot keys (h1, h2, ...): broadcast if they are few, else dealt to copies."""
    if few:
        return rows.join(F.broadcast(hot), ["h1", "h2"], how)
    many = hot.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return rows.withColumn("_copy", F.pmod(F.xxhash64("id", "rk", "pos"), F.lit(copies)).cast("int")).join(many, ["h1", "h2", "_copy"], how).drop("_copy")


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, most_rows: int = MOST_ROWS, most_hot: int = MOST_HOT) -> DataFrame:
    """(id, rk, dropped): the positions of each document's dropped lines, ascending; only documents with any."""
    spark = docs.sparkSession
    rows = checkpointed(keyed_lines(docs, min_chars))
    limit = min(max(HOT_ROWS, int(rows.count() * HOT_SHARE)), most_rows)
    heavy = checkpointed(rows.groupBy("h1", "h2").count().where(F.col("count") > limit).select("h1", "h2"))
    few = heavy.count() <= most_hot  # always so up to 4096 * most_rows rows
    hot = checkpointed(
        with_hot(rows, heavy, "inner", few)
        .groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("id").alias("keeper"))
    )
    of_hot = with_hot(rows, hot, "inner", few).where((F.col("n_docs") >= min_docs) & (F.col("id") < F.col("keeper"))).select("id", "rk", "pos")
    bits = max(RANGE_BITS, (4 * shuffle_partitions(spark)).bit_length())
    ranged = with_hot(rows, hot.select("h1", "h2"), "left_anti", few).withColumn("range", F.shiftrightunsigned("h1", 64 - bits)).repartition(shuffle_partitions(spark), "range")
    run = Window.partitionBy("range", "h1", "h2").orderBy(F.desc("id"), F.desc("rk"), "pos")
    # a document's number in its run; the last one is the number of documents
    new = F.coalesce(F.lag("id").over(run) != F.col("id"), F.lit(True)).cast("int")
    streamed = ranged.withColumn("new", new).withColumn("keeper", F.first("id").over(run))
    whole = Window.partitionBy("range", "h1", "h2").orderBy(F.desc("id"), F.desc("rk"), "pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_rest = streamed.withColumn("n_docs", F.sum("new").over(whole)).where((F.col("n_docs") >= min_docs) & (F.col("id") < F.col("keeper"))).select("id", "rk", "pos")
    return of_hot.unionByName(of_rest).groupBy("id", "rk").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def run_lengths(dropped: Column) -> Column:
    """A bitmap of lines by runs of dropped ones: "first+length,first+length,..."; other lines are kept."""
    at = lambda i: F.get(dropped, i)
    starts = F.filter(dropped, lambda p, i: F.coalesce(at(i - 1) != p - 1, F.lit(True)))
    ends = F.filter(dropped, lambda p, i: F.coalesce(at(i + 1) != p + 1, F.lit(True)))
    return F.array_join(F.zip_with(starts, ends, lambda s, e: F.concat(s.cast("string"), F.lit("+"), (e - s + 1).cast("string"))), ",")


def kept_text(text: Column, dropped: Column) -> Column:
    """The text without its dropped lines, in time linear in its lines: slices between them."""
    lines = F.split(text, "\n", -1)
    bounds = F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))
    gaps = F.transform(F.slice(bounds, 1, F.size(dropped) + 1), lambda b, i: F.slice(lines, b + 2, F.get(bounds, i + 1) - b - 1))
    return F.array_join(F.flatten(gaps), "\n")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, **limits) -> DataFrame:
    """docs with four columns more: ``_n_lines``, ``_n_dropped``, ``_keep_bitmap`` and ``_kept_text``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    id_key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    rk = F.xxhash64(F.col(id_col).isNull(), text)
    dropped = dropped_lines(docs.select(id_key.alias("id"), rk.alias("rk"), text.alias("text")), min_chars, min_docs, **limits)
    side = dropped.select(F.col("id").alias("_id"), F.col("rk").alias("_rk"), F.col("dropped").alias("_dropped")).hint("shuffle_hash")
    joined = docs.withColumn("_key", id_key).withColumn("_row", rk).join(side, (F.col("_key") == F.col("_id")) & (F.col("_row") == F.col("_rk")), "left")
    some = F.col("_dropped").isNotNull()
    return joined.select(
        *[F.col(c) for c in docs.columns],
        (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("_n_lines"),
        F.when(some, F.size("_dropped")).otherwise(0).cast("long").alias("_n_dropped"),
        F.when(some, run_lengths(F.col("_dropped"))).otherwise("").alias("_keep_bitmap"),
        F.when(some, kept_text(text, F.col("_dropped"))).otherwise(text).alias("_kept_text"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(spread(documents(spark, sf_dir).select("doc_id", "text")))
    return found.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(F.col("_kept_text"), 256).alias("kept_sha256"), F.col("_keep_bitmap").alias("keep_bitmap"))


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, pos, line, translate(trim(line, E' \t\n\x0B\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))
),
k AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
v AS (SELECT l.doc_id, l.pos, l.line, k.keeper IS NOT NULL AND l.doc_id < k.keeper AS dropped FROM l LEFT JOIN k ON l.key = k.key),
r AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM v WHERE dropped),
b AS (SELECT doc_id, string_agg(CAST(p - 1 AS VARCHAR) || '+' || CAST(n AS VARCHAR), ',' ORDER BY p) AS keep_bitmap FROM (SELECT doc_id, g, min(pos) AS p, count(*) AS n FROM r GROUP BY doc_id, g) GROUP BY doc_id)
SELECT v.doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256, coalesce(any_value(b.keep_bitmap), '') AS keep_bitmap
FROM v LEFT JOIN b ON v.doc_id = b.doc_id GROUP BY v.doc_id
"""
