"""From raw documents to packed sequences: five stages, each written as Parquet and read again by the next.

Every stage but the last returns the columns of ``documents``. Rows with null or empty texts go through all stages (an
empty text has nothing against it); a document that loses all its lines stays, with an empty text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm import decontamination, line_dedup, packing, quality, simhash
from lakeshift.llm.common import documents, shared_dir, spread


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (fitted on the labels of the training folds) doesn't reject."""
    model = quality.fit(documents(spark, sf_dir), documents(spark, sf_dir, "labels"), quality.fold() != 0)
    return quality.score(docs, model).where(F.col("_score") >= quality.THRESHOLD).drop("_score")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of larger id keeps; n_chars follows the text."""
    found = line_dedup.dedup_lines(docs)
    changed = F.col("_n_dropped") > 0
    return found.withColumn("text", F.when(changed, F.col("_kept_text")).otherwise(F.col("text"))).withColumn("n_chars", F.when(changed, F.char_length("_kept_text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near duplicates."""
    return simhash.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontamination.decontaminated(docs, documents(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", without_near_duplicates),
    ("benchmark_decontamination", without_benchmarks),
    ("packing", packed),
]

#: SQL can express neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the others write stays in the shared checkpoint folder."""
    docs = spread(documents(spark, sf_dir))
    out = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{k}-{name}")
        docs = spark.read.parquet(f"{out}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
