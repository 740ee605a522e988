"""Pipeline from raw documents to packed training sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and reread as the next one's docs. All but the last return the columns of documents. Each stage works on all rows
that the one before it kept:

1. toxicity: rows that the classifier scores at its threshold or above go. It learns from the labelled rows at hand that
   are not held out.
2. quality_rules: rows that the base rule or a fertility band rejects go.
3. simhash_dedup: of each group of near duplicates the row of smallest id stays.
4. suffix_dedup: bytes of windows that also start earlier go; n_chars follows the text.
5. best_fit_packing: token pieces with their sequence and place (see the operator).

Null texts have no words and go in stage 2. An empty table passes all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comparo.llm import fertility, pack, simhash_gray, suffix_dedup, toxicity
from comparo.llm.common import documents, materialize
from comparo.sources.tables import read_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.reject_toxic(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fertility.keep_good(docs, fertility.public_vocabulary())


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_gray.keep_one(docs, size=3, max_bits=2)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.cut_repeats(docs)
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(cut.schema["n_chars"].dataType))
    return cut


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack.pack(pack.pieces(docs, pack.public_vocabulary())).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", reject_toxic),
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
