import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridloom.llm import exact_dedup
from gridloom.llm.common import give_back


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.unhex(F.left(F.sha2(t, 256), F.lit(1))), lambda t: F.lit(b"one")])
def test_rows_equal_brute_force_also_where_digests_collide(docs, digest):
    rows = [r.asDict() for r in docs.collect()]
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r["text"])].append(r["doc_id"])
    out = exact_dedup.annotate(docs, digest=digest).select("doc_id", "text", "__dd_keep_id", "__dd_size", "__dd_kept", F.lower(F.hex("__dd_digest")).alias("sha")).collect()
    assert len(out) == len(rows)
    kept = defaultdict(int)
    for r in out:
        ids = groups[norm(r.text)]
        assert r["__dd_keep_id"] == min((i for i in ids if i is not None), default=None) and r["__dd_size"] == len(ids)
        assert digest is not exact_dedup.sha256 or r.sha == hashlib.sha256(norm(r.text).encode()).hexdigest()
        if r["__dd_kept"]:
            kept[norm(r.text)] += 1
            assert r.doc_id == r["__dd_keep_id"]
    assert set(kept) == set(groups) and set(kept.values()) == {1}


def test_stage_keeps_columns_and_one_row_each(docs, empty):
    more = docs.withColumn("digest", F.lit(1)).withColumn("salt", F.lit("x")).withColumn("keep_id", F.lit(None).cast("int"))
    out = exact_dedup.keep_first(more)
    assert out.columns == more.columns and out.count() == len({norm(r.text) for r in docs.collect()})
    assert exact_dedup.keep_first(empty).count() == 0 and exact_dedup.annotate(empty).count() == 0


def test_a_hot_text_is_one_group(spark):
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same  text").otherwise(F.col("id").cast("string")).alias("text"))
    r = exact_dedup.annotate(hot).filter("doc_id % 3 = 0").agg(F.count(F.lit(1)), F.max("__dd_size"), F.count_if("__dd_kept")).first()
    assert tuple(r) == (1000, 1000, 1)


def test_hot_groups_come_back_over_salts(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    out = give_back(rows, groups, ["k"], "n", "id", hot=50)
    r = out.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("top").alias("top"), F.countDistinct("__gb_salt").alias("salts")).filter("k = 0").first()
    assert out.count() == 5000 and out.filter("top is null").isEmpty() and (r.n, r.top) == (3000, 2999) and 25 <= r.salts <= 50
