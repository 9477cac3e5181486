"""A corpus pipeline: good documents, one of each group of near copies, without repeated passages, without benchmark
passages, packed. Each stage reads what the stage before wrote; all but the last return the columns of documents.

In every stage a null text counts as empty, texts are read whole, repeated rows are rows of their own (near copies keep one of
them), an empty table gives an empty table, and further columns come back as they were, whatever their names. Ids may be
null or repeat, and are never inputs of a decision, but for ties between near copies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benthic_jobs.llm import decontaminate, ngram_join, packing, quality, substring_dedup
from benthic_jobs.llm.shared import stored


#: The column that carries what the stages don't read. No column of ``documents`` may have this name.
_REST = "columns_of_the_caller"


def _on_text(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on doc_id, text and one struct with all other columns, which are unpacked after it: no name can clash.

    Names are compared as Spark does, without their case. Where texts change, ``n_chars`` follows them.
    """
    rest = [c for c in docs.columns if c.lower() not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(F.lit(0).alias("none"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest))).alias(_REST))
    done = work(packed)
    at = {c: F.col(f"{_REST}.c{i}") for i, c in enumerate(rest)}
    return done.select(*(at.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; equal texts share their fate, and an empty one has a score too."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _on_text(docs, lambda docs: quality.keep_good(docs, labels))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least id stays (null ids come last); of repeated rows one.

    Texts without words are no copies of anything.
    """
    return _on_text(docs, ngram_join.keep_one)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in several places go; a document that is nothing else goes with them.

    Texts of which nothing is removed, empty and null ones too, stay as they are, to the letter.
    """

    def work(docs: DataFrame) -> DataFrame:
        done = substring_dedup.remove_repeats(docs)
        text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
        return done.where("n_removed = 0 or n_removed < n_words").withColumn("text", text)

    kept = _on_text(docs, work)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go, whether the item has an id or not."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")

    return _on_text(docs, lambda docs: decontaminate.find_contamination(docs, items).where(F.size("hit_spans") == 0))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, with their sequences; an empty text packs as the end id alone."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("near_copies", one_of_near_copies),
    ("repeats", without_repeats),
    ("benchmarks", without_benchmarks),
    ("packing", packed),
]

#: Neither a trained classifier nor a tokenizer can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
