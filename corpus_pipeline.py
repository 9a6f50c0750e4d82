"""The corpus pipeline: stages applied to ``documents`` one after the other, each written and read again.

Every stage takes all rows that the one before kept and returns the columns of ``documents``; the last one adds how often to read
each document. Nulls, empty texts, repeated rows and empty tables are handled as the stages' operators say; a row without identifier
is never taken for a near copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm import languages, lines, mixing, near, templates
from placeweave.llm.shared import stored, table
from placeweave.session import counted_side

# Rows of whole texts that travel to Python at once; a batch of Spark's 10,000 stands several times in an executor's memory, for every task.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Sets the session's batches to at most ``BATCH_ROWS`` rows, for all stages; a smaller setting stays."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, BATCH_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (no letters, or no language clearly likelier); ``lang`` becomes the predicted one."""
    small_batches(spark)
    model = languages.train(docs.where(~languages.held_out(F.col("doc_id"))))
    judged = languages.predict(docs.select(F.struct("*").alias("row"), "text"), model, keep=("row",))
    kept = judged.where((F.col("lang_pred") != languages.UNDETERMINED) & (F.col("score") >= languages.MIN_SCORE))
    return kept.select(*[F.col("lang_pred" if c == "lang" else f"row.{c}").alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes cross-site boilerplate out of the texts; every document stays."""
    return lines.without_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest identifier, once."""
    kept = near.near_groups(docs).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count_if("kept").alias("rows"))
    # Far fewer than those that stay, so texts need not be shuffled to meet them as long as they are few.
    others = stored(kept.where("rows <> 1"), "near-not-once")
    once = docs.join(counted_side(others.select("doc_id")), "doc_id", "left_anti")
    repeated = docs.join(counted_side(others.where("rows > 1").select("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(repeated)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return templates.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Selects documents by the mixture's token budget; adds ``mix_domain``, ``mix_tokens`` and ``mix_copies``."""
    return mixing.mixed_to_weights(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing_to_weights),
]

# The language stage scores with a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
