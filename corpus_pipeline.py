"""A training corpus from raw documents, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``docs``:

1. documents without a language go;
2. of each group of near duplicates one document stays;
3. byte strings that an earlier document holds are cut out;
4. sources are mixed to their target weights;
5. what is left is tokenised and packed into windows; the token ids are in
   the rows, and ``packing.sequences`` joins them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arbiter.llm import language_id, mixing, packing, simhash, suffix_dedup
from arbiter.llm.common import drop_written, prepare, written
from arbiter.llm.queries import bpe_50k


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def cut_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffix_dedup.cut_repeats(docs, length=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs, **bpe_50k(), with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_bytes),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Training, hashing of fingerprints and tokenising can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if held is not None:
            drop_written(held)
        held = docs
    return docs
