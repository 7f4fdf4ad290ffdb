"""The documents' way to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
All but the last return the columns of documents; n_chars follows a changed text.

Defined cases, besides those of the operators' modules: a null or empty text is rejected by the first stage, and kept by
each later one as its operator says; texts of any length are read whole; of equal rankings the smaller doc_id stays;
repeated rows are judged alike by every stage but near_dedup, which keeps one of them; an empty table gives an empty one;
further columns, whatever their names, stay as they are up to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm import decontaminate, packing, repetition, simhash, winnowing
from perigee.llm.queries import TOKENIZER
from perigee.llm.shared import folder, read

#: Characters of #*$%&|<> to a word; beyond it a text is a table or debris.
MAX_SYMBOLS = 0.3


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the operator's rules reject go, and by a rule of this stage those with many symbols to a word."""
    return repetition.keep_good(docs, max_symbols=MAX_SYMBOLS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of passages, which begin and end inside lines, go from the texts."""
    return _recounted(winnowing.delete_passages(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go, and documents that mostly consist of them."""
    return _recounted(decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, TOKENIZER, with_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: No SQL expresses near_dedup's components, nor the tokeniser.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written to the shared folder and read again."""
    root = f"{folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
