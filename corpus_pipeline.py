"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, folder) and works on all that the stage before has kept;
its result is written as a table and read again as the next one's input. All stages but the last
return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolag.llm import decontaminate, neardup, pii, rules
from aerolag.llm.common import discarding, kept, table
from aerolag.llm.queries import packed


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the rules, without the lines that are too frequent on their host."""
    return rules.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates, by five-word shingles."""
    return neardup.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that share no ten words with the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, folder, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents with personal data masked."""
    return pii.masked(docs, pii.fit(docs))


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids."""
    return packed(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# The tagger of the fourth stage is beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The packed sequences of the whole table of documents."""
    docs = table(spark, folder, "documents")
    for _, stage in STAGES[:-1]:
        # What the stage has stored on its way goes as soon as its result is written.
        with discarding(spark):
            docs = kept(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
