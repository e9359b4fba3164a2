import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.llm import toxicity as tx

DATA = "/root/testdata/sf0.1"


def test_held_out_accuracy():
    d = pd.read_parquet(f"{DATA}/documents.parquet").merge(pd.read_parquet(f"{DATA}/labels.parquet"), on="doc_id")
    out = np.array([zlib.crc32(str(i).encode()) % 4 == 2 for i in d.doc_id])
    model = tx.train(d.text[~out].tolist(), d.toxic[~out].tolist())
    score, y = np.array([model.score(t) for t in d.text[out]]), d.toxic[out].to_numpy()
    predicted = score >= tx.THRESHOLD
    assert y[predicted].mean() > 0.95 and predicted[y == 1].mean() > 0.9 and predicted[y == 0].mean() < 0.01
    rank = pd.Series(score).rank().to_numpy()
    assert (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum()) > 0.95


def test_negative_part_is_kept_from_going_below_zero(monkeypatch):
    texts, y = ["bad idiot words here"] * 6 + [f"plain text {i % 3} words" for i in range(30)], [1] * 6 + [0] * 30
    model = tx.train(texts, y, steps=60)
    assert model.score(texts[0]) > 0.5 > model.score(texts[-1])
    monkeypatch.setattr(tx, "BETA", -10.0)  # every step now takes the other branch: it moves away from calling U negative
    assert tx.train(texts, y, steps=20).score(texts[-1]) > tx.train(texts, [1] * 6 + [0] * 30, steps=0).score(texts[-1])


def test_query_learns_from_three_quarters_only(spark, tmp_path):
    rows = tx.op9_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = tx.fit(docs, labels), tx.fit(docs.repartition(3), other)
    assert a.weights == b.weights and a.bias == b.bias


def test_cases(spark, docs, empty):
    labels = spark.createDataFrame([(6, None), (None, 1), (7, 0), (7, 0), (15, 1)], "doc_id long, toxic int")
    model = tx.fit(docs, labels)
    out = tx.scored(docs.withColumn("score", F.lit("x")), model)
    assert out.count() == docs.count() and out.filter("__tx_score IS NULL OR __tx_score < 0 OR __tx_score > 1").count() == 0
    none = tx.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert tx.scored(docs, none).agg(F.max("__tx_score")).first()[0] == 0.0
    assert tx.scored(empty, model).count() == 0


def test_samples_are_bounded_and_unlabelled_texts_are_read(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"))
    docs = docs.unionByName(spark.range(20_000).select(F.lit(8).cast("long").alias("doc_id"), F.concat(F.lit("same id "), F.col("id")).alias("text")))
    labels = spark.createDataFrame([(i, i % 2) for i in (*range(400), *[8] * 30)], "doc_id long, toxic int").unionByName(spark.range(20_000).select(F.lit(9).cast("long").alias("doc_id"), F.lit(1).alias("toxic")))
    rows = tx.learnt_from(docs, labels, 50, 100).collect()
    assert sum(r.p for r in rows) <= 50 and 90 <= sum(r.u for r in rows) <= 100 and len(rows) == len({r.doc_id for r in rows}) <= 150
    assert all(r.doc_id % 2 == 1 and r.doc_id < 400 for r in rows if r.p) and sum(r.p for r in rows) >= 30
    assert sum(r.u and r.doc_id >= 400 for r in rows) > 70  # without a label
    assert not any(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    zeros = labels.withColumn("toxic", F.when(F.col("toxic") == 0, None).otherwise(F.col("toxic")))
    assert tx.fit(docs, labels, 50, 100).weights == tx.fit(docs, zeros, 50, 100).weights  # labels of 0 are never read


def test_risk_and_gradient_equal_plain_loops():
    rng = np.random.default_rng(1)
    z, in_p = rng.normal(0, 2, 30), np.arange(30) < 9
    for prior in (0.1, 0.4):
        sp, su = prior * in_p / 9, ~in_p / 21
        plus, minus, gp, gn = tx.risk(z, sp, su)
        loss = lambda v, y: float(np.log(1 + np.exp(-y * v)))
        parts = lambda q: (prior * sum(loss(v, 1) for v in q[:9]) / 9, sum(loss(v, -1) for v in q[9:]) / 21 - prior * sum(loss(v, -1) for v in q[:9]) / 9)
        assert (plus, minus) == pytest.approx(parts(z))
        for i in range(30):
            up, down = z.copy(), z.copy()
            up[i] += 1e-5
            down[i] -= 1e-5
            slopes = [(a - b) / 2e-5 for a, b in zip(parts(up), parts(down), strict=True)]
            assert (gp[i], gn[i]) == pytest.approx(slopes, abs=1e-6)


def test_matrix_products_equal_plain_loops():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{rng.integers(30)}" for _ in range(rng.integers(0, 40))) for _ in range(50)]
    vectors = [tx.vector(t) for t in texts]
    x = tx.Matrix(vectors)
    w, g = rng.normal(size=len(x.names)), rng.normal(size=50)
    place = {int(n): i for i, n in enumerate(x.names)}
    dense = np.zeros((50, len(place)))
    for i, (names, values) in enumerate(vectors):
        for n, v in zip(names, values, strict=True):
            if int(n) in place:
                dense[i, place[int(n)]] = v
    assert (dense > 0).sum(axis=0).min() >= tx.LEAST_DOCS
    assert x.times(w) == pytest.approx(dense @ w, abs=1e-5) and x.turned_times(g) == pytest.approx(dense.T @ g, abs=1e-5)


def test_the_prior_comes_from_scores_of_both_samples():
    rng = np.random.default_rng(4)
    for share in (0.05, 0.2, 0.4):
        p, u = rng.normal(3, 1, 800), np.where(rng.random(5000) < share, rng.normal(3, 1, 5000), rng.normal(-1, 1, 5000))
        assert tx.best_bin(p, u) == pytest.approx(share, abs=0.04)


@pytest.mark.parametrize("texts", [[], ["only"]])
def test_training_on_next_to_nothing(texts):
    assert tx.train(texts, [1] * len(texts)).score("anything") >= 0
