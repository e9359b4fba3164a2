"""A training corpus from the documents table in five stages.

toxicity      drops documents that score as toxic,
exact_dedup   keeps the first of equal texts,
near_dedup    keeps one document of each class of near copies,
pii           replaces personal data by its kind in brackets,
packing       packs what is left into sequences of 1024 tokens.

Each stage reads all that the one before kept; all but the last return the columns of
documents. Nulls, repeated rows, empty tables and further columns are handled as the operators
say: a null text counts as empty and stays null, an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import exact_dedup, packing, pii, probminhash, toxicity
from gridloom.llm.common import discard, materialise, table
from gridloom.ship import shipped


@shipped
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).filter(F.col("__tx_score") < toxicity.THRESHOLD).select(*docs.columns)


@shipped
def keep_first_of_equals(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


@shipped
def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return probminhash.keep_one(docs)


@shipped
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return clean.select(*docs.columns)


@shipped
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", keep_first_of_equals),
    ("near_dedup", keep_one_of_near),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # SQL expresses neither the classifier nor the tokenizer; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = materialise(stage(spark, docs, sf_dir), name)
        discard(docs)  # what the stage before wrote has no more readers; the documents themselves stay
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
