"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

1. language ID drops texts without a letter and those of which the words follow no language surely;
2. line dedup removes lines that many sites share, and documents of which nothing else is left;
3. MinHash near-dedup keeps one document of each group, that of the smallest doc_id;
4. decontamination drops documents that hold a benchmark item;
5. best-fit packing places the token pieces of what remains in sequences of 2048.

All stages but the last return the columns of documents, and further ones that they came with, whatever
their names. A null or empty text has no letter, so it goes with the first stage; without labelled documents
every text does. A null doc_id is a document like others; repeated rows are near copies of each other,
of which one stays. Without documents there are no rows, without benchmark items nothing is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimlake.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from claimlake.llm.store import discard, materialise, read_documents
from claimlake.llm.tokens import default_tokenizer

#: A text is rejected if the labels of its words, and of SURE_WORDS sure ones beside them, are less sure on average.
LEAST_SURE, SURE_WORDS = 0.75, 10


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chain = language_id.train(docs.select("doc_id", "text", "lang"))
    return language_id.keep_clear(docs, chain, LEAST_SURE, SURE_WORDS)


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_boilerplate(docs)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, default_tokenizer())


STAGES = [
    ("language_id", stage_language),
    ("line_dedup", stage_line_dedup),
    ("near_dedup", stage_near_dedup),
    ("decontaminate", stage_decontaminate),
    ("pack", stage_pack),
]

#: SQL can express neither the learned field nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``."""
    docs, before = read_documents(spark, sf_dir), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            before, docs = before, materialise(docs, name)
            if before is not None:  # nothing reads it any more
                discard(before)
            before = docs
    return docs
