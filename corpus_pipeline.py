"""The training-data pipeline: documents to packed sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
rows its predecessor kept, and all but the last return the columns of
``documents``. ``run`` writes every stage's result as Parquet into the folder
named by ``spark.checkpoint.dir`` and reads it back for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm import decontaminate, jaccard_join, language_id, packing, suffix_dedup
from tabula.llm.queries import table, tokenizer_path
from tabula.session import shared_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Bytes of a repeated passage. A passage of over 50 words is longer in any of
#: the languages; license lines and set phrases of clean documents are shorter.
REPEAT_BYTES = 100


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compressors tell; rejected ones go (no
    letter, or no language ahead of the others)."""
    model = language_id.fit(docs)
    return language_id.predict(docs, model, keep=COLUMNS).where(~F.col("rejected")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingle similarity 0.8 or more."""
    return jaccard_join.keep_one(docs.select(*COLUMNS), k=5, num=80, den=100)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has, too, are cut out."""
    out = suffix_dedup.remove_repeats(docs.select(*COLUMNS), length=REPEAT_BYTES)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))).select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return decontaminate.remove_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", "item_id", "text"), window=10)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of the remaining texts, with their token ids."""
    return packing.pack(docs, tokenizer_path(), max_length=2048, end_id=1, special=True)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: SQL cannot express compression, shingle components or byte-pair encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for i, (name, stage) in enumerate(STAGES):
        path = shared_path(spark, f"pipeline-{uuid.uuid4().hex[:12]}/{i}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
