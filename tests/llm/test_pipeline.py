"""The pipeline on a small table, and the contract of its stages."""

import os
import random
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline
from aerolag.llm import queries
from tests.llm.conftest import prose


def folder(tmp_path):
    pick = random.Random(8)
    texts = [prose(pick, 80) for _ in range(12)]
    leaked = prose(pick, 30)
    texts[1] += " " + leaked
    texts[2] += " write to a.b@mail.org"
    texts += [texts[0], texts[3] + " more", "short text", None]
    documents = pa.table(
        {
            "doc_id": pa.array(range(len(texts)), pa.int64()),
            "text": pa.array(texts, pa.string()),
            "lang": ["en"] * len(texts),
            "source": ["s"] * len(texts),
            "n_chars": pa.array([len(t or "") for t in texts], pa.int64()),
        }
    )
    pq.write_table(documents, tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": [1], "text": [leaked]}), tmp_path / "benchmark.parquet")
    return str(tmp_path), texts


def test_stages_take_effect(spark, tmp_path):
    where, texts = folder(tmp_path)
    docs, kept = spark.read.parquet(f"{where}/documents.parquet"), []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        docs = stage(spark, docs, where)
        path = os.path.join(where, f"stage{number}")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        assert number == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        kept.append({row["doc_id"] for row in docs.select("doc_id").collect()})
    everything = set(range(12))
    # Too short ones go, then copies, then what leaked; masking keeps all.
    assert kept == [everything | {12, 13}, everything, everything - {1}, everything - {1}, everything - {1}]
    masked = spark.read.parquet(os.path.join(where, "stage3")).where("doc_id = 2").first()
    assert masked["text"].endswith("write to <email>")
    assert corpus_pipeline.ORACLE_SQL is None
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "near_duplicates",
        "decontamination",
        "personal_data",
        "packing",
    ]


def test_run_packs_what_is_left(spark, tmp_path):
    where, _ = folder(tmp_path)
    pieces = corpus_pipeline.run(spark, where).collect()
    assert {row["doc_id"] for row in pieces} == set(range(12)) - {1}
    assert all(len(row["ids"]) == row["length"] for row in pieces)


def test_repeated_rows_without_ids_and_empty_tables_through_all_stages(spark, tmp_path):
    where, texts = folder(tmp_path)
    docs = spark.read.parquet(f"{where}/documents.parquet")
    # Every row three times, and one text also without an id.
    without = docs.where("doc_id = 5").selectExpr("cast(null as bigint) as doc_id", *docs.columns[1:])
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = os.path.join(where, f"in{number}")
        (docs.union(docs).union(docs).union(without) if number == 0 else docs).write.parquet(path)
        docs = stage(spark, spark.read.parquet(path), where)
    pieces = docs.collect()
    assert {row["doc_id"] for row in pieces} == set(range(12)) - {1}
    lengths = Counter()
    for row in pieces:
        lengths[row["doc_id"], row["doc_tokens"]] += row["length"]
    assert all(tokens == length for (_, tokens), length in lengths.items())
    empty = spark.read.parquet(f"{where}/documents.parquet").where("false")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = os.path.join(where, f"empty{number}")
        empty.write.parquet(path)
        empty = stage(spark, spark.read.parquet(path), where)
    assert empty.count() == 0


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
