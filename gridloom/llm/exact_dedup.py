"""Exact deduplication by skew-safe combining, on DataFrame functions alone.

Texts are equal when they are identical after each run of ASCII white space became one
space; a null text counts as empty. Equal texts meet in three steps, and each step groups
by the whole text beside its digest, so equality never rests on the digest alone:

1. every task combines its own rows (the map side of the first aggregation),
2. groups salted by the row's id combine, so a text that holds a third of all rows is
   spread over ``SALTS`` tasks,
3. the salts' winners, at most ``SALTS`` a text, combine into one.

The third step also counts the texts of each digest. Where a digest has one, that step has
compared the whole text of all its rows, and decisions go back to the rows by the digest;
the rows of a digest with several texts (a collision) get theirs by the whole text.

Defined cases: of equal texts the smallest id stays; null ids lose to all others; of rows
that repeat id and text exactly one stays (the first by ``ties``); an empty table gives
an empty result; other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import give_back, materialise, table, whole_text

SALTS = 32


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space; single spaces are left where they are."""
    return F.regexp_replace(whole_text(text), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def annotate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ties: Sequence[str] = (), salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The rows of docs with __dd_keep_id, __dd_size, __dd_kept and __dd_digest."""
    norm = normalised(F.col(text_col))
    keyed = docs.withColumn("__dd_digest", digest(norm))
    texts = (
        keyed.select("__dd_digest", F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("__dd_salt"), norm.alias("__dd_norm"), F.col(id_col).alias("__dd_id"))
        .groupBy("__dd_digest", "__dd_salt", "__dd_norm").agg(F.min("__dd_id").alias("__dd_id"), F.count(F.lit(1)).alias("__dd_n"))
        .groupBy("__dd_digest", "__dd_norm").agg(F.min("__dd_id").alias("__dd_keep_id"), F.sum("__dd_n").alias("__dd_size"))
    )
    groups = materialise(texts.groupBy("__dd_digest").agg(F.count(F.lit(1)).alias("__dd_texts"), F.min("__dd_keep_id").alias("__dd_keep_id"), F.sum("__dd_size").alias("__dd_size")), "digests")
    several = groups.filter("__dd_texts > 1").select("__dd_digest")
    keys = ["__dd_digest"]
    if not several.isEmpty():  # a digest of several texts: its rows meet by their texts
        texts = texts.join(several, "__dd_digest", "left_semi")
        own = F.when(F.col("__dd_texts").isNotNull(), normalised(F.col(text_col)))
        keyed = keyed.join(several.withColumn("__dd_texts", F.lit(True)), "__dd_digest", "left").withColumn("__dd_own", F.coalesce(own, F.lit(""))).drop("__dd_texts")
        plain = groups.filter("__dd_texts = 1").select("__dd_digest", F.lit("").alias("__dd_own"), "__dd_keep_id", "__dd_size")
        groups = materialise(plain.unionByName(texts.withColumnRenamed("__dd_norm", "__dd_own")), "digests")
        keys = ["__dd_digest", "__dd_own"]
    else:
        groups = groups.drop("__dd_texts")
    same = Window.partitionBy(*keys, "__gb_salt", id_col).orderBy(*(ties or [F.lit(0)]))
    return (
        give_back(keyed, groups, keys, "__dd_size", id_col, "inner")
        .withColumn("__dd_nth", F.row_number().over(same))
        .withColumn("__dd_kept", F.col(id_col).eqNullSafe(F.col("__dd_keep_id")) & (F.col("__dd_nth") == 1))
        .drop("__dd_nth", "__dd_own", "__gb_salt")
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of docs that stay, with their columns and no others."""
    ties = [c for c in docs.columns if c not in (id_col, text_col)] + [text_col]
    return annotate(docs, id_col, text_col, ties, salts).filter("__dd_kept").select(*docs.columns)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.col("__dd_keep_id").alias("keep_id"), F.col("__dd_size").alias("group_size"), F.col("__dd_kept").alias("kept"), F.lower(F.hex("__dd_digest")).alias("text_sha256"))


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""
