"""One query for each operator of this subpackage, over its whole table, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    audio_match, centroids, chat_format, decontaminate, fill_middle, html_extract, language_id, ngram_join, packing, quality, sharding, substring_dedup, warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.near_duplicates(docs).select("doc_id", "class_id", "n_links")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark")))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.digest(warc.read_records(warc.write_archives(pages)))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, train=~quality.fold(4, 2))
    tagged = language_id.tagged(docs.select("doc_id", "text"), model)
    return tagged.select("doc_id", quality.fold(4, 2).alias("held_out"), "lang_pred", "score")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(chat_format.PROBE, rows.schema)
    records = chat_format.from_rows(rows.unionByName(probe))
    return chat_format.read_back(chat_format.format_turns(chat_format.known(chat_format.canonical_turns(records))))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), train=~quality.fold(3, 1))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return quality.scored(docs, model).select("doc_id", quality.fold(3, 1).alias("held_out"), "score", predicted)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.digest(substring_dedup.remove_repeats(docs))


def op9_audio_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    sound = audio_match.sonified(table(spark, sf_dir, "embeddings"))
    return audio_match.search(audio_match.fingerprints(sound), F.col("recording_id") % 20 == 0)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_middle.read_back(fill_middle.assembled(docs))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.digest(sharding.read_shards(spark, sharding.write_shards(docs), docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_decontamination": op2_decontamination,
    "op3_warc": op3_warc,
    "op4_language_id": op4_language_id,
    "op5_chat_format": op5_chat_format,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_audio_match": op9_audio_match,
    "op10_html_extract": op10_html_extract,
    "op11_fill_middle": op11_fill_middle,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_sharding": op13_sharding,
}
ORACLE_SQL: dict[str, str] = {
    "op1_ngram_join": ngram_join.ORACLE,
    "op2_decontamination": decontaminate.ORACLE,
    "op3_warc": warc.ORACLE,
    "op5_chat_format": chat_format.ORACLE,
    "op8_substring_dedup": substring_dedup.ORACLE,
    "op11_fill_middle": fill_middle.ORACLE,
    "op12_centroid_clustering": centroids.ORACLE,
    "op13_sharding": sharding.ORACLE,
}
