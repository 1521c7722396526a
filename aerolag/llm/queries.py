"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.llm import (
    chat,
    decontaminate,
    license,
    neardup,
    packing,
    pii,
    quality,
    rules,
    spelling,
    substring,
    toxicity,
    trie,
    warc,
)
from aerolag.llm.common import new_folder, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_quality_gam(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(documents, table(spark, folder, "labels"))
    return quality.scored(documents, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op2_chat_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return chat.rendered(chat.maximal(table(spark, folder, "conversations")))


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = license.scanned(documents, license.fit(documents))
    families = F.array_sort(F.array_distinct("licences.found.family"))
    return found.select(
        "doc_id",
        F.col("licences.n_paragraphs").alias("n_paragraphs"),
        F.size("licences.found").cast("long").alias("n_found"),
        F.array_join(families, ",").alias("families"),
        F.array_join(F.transform("licences.found.line", lambda x: x.cast("string")), ",").alias("lines"),
    )


@query
def op4_pii_bilstm_crf(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return pii.find(documents, pii.fit(documents)).select("doc_id", "pii.*")


@query
def op5_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    archives = new_folder(spark, "warc")
    index = warc.write_archives(table(spark, folder, "pages"), archives)
    records = warc.read_records(index, archives, with_payload=False)
    return records.withColumnRenamed("page", "page_id").drop("url")


@query
def op6_sentence_span_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return substring.deduplicated(documents).select("doc_id", "dedup.*")


@query
def op7_line_frequency_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(table(spark, folder, "documents"))


def packed(documents: DataFrame, with_ids: bool = False) -> DataFrame:
    import public_tokenizers

    return packing.pack(
        documents,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        with_ids=with_ids,
    )


@query
def op8_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


@query
def op9_odd_sketch_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), width=2)


@query
def op10_winnowing_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    judged = decontaminate.contamination(documents, table(spark, folder, "benchmark"))
    return judged.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        F.col("hits.n_hit").alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


@query
def op11_parentheses_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    return trie.prefix_trie(trie.rebuilt(turns))


@query
def op12_trie_node_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, folder, "documents")))


@query
def op13_toxicity_fm(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, folder, "labels"))
    return toxicity.scored(documents, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )
