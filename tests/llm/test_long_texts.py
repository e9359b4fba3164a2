"""Texts of megabytes go through every operator whole."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gridloom.llm import exact_dedup, fingerprint, packing, pieces, pii, probminhash, secrets, toxicity


@pytest.fixture(scope="module")
def long_docs(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(5000)]
    text = "\n".join(" ".join(rng.choice(words) for _ in range(12)) + "." for _ in range(40_000))
    end = "\nmail last@example.com password=hunter2hunter2"
    rows = [(1, text + end), (2, text + end), (3, text.replace("a", "A", 1) + " more" + end), (4, "x" * 2_000_000), (5, "short")]
    return text + end, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_spans_and_copies_of_long_texts(spark, long_docs, tmp_path):
    text, docs = long_docs
    assert len(text) > 2_000_000
    found = {r.doc_id: r["__pii_spans"] for r in pii.find(docs).select("doc_id", "__pii_spans").collect()}
    assert [(s.kind, text[s.start : s.end]) for s in found[1]] == [("email", "last@example.com")] and not found[4]
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[1] == text.replace("last@example.com", "[EMAIL]") and clean[4] == "x" * 2_000_000
    keys = {r.doc_id: r.findings for r in secrets.update(docs, f"file://{tmp_path}/ledger", "doc_id").collect()}
    assert [text[s.start : s.end] for s in keys[2]] == ["password=hunter2hunter2"]
    kept = {r.doc_id: r["__dd_kept"] for r in exact_dedup.annotate(docs).select("doc_id", "__dd_kept").collect()}
    assert kept == {1: True, 2: False, 3: True, 4: True, 5: True}


def test_classes_and_fingerprints_of_long_texts(long_docs):
    text, docs = long_docs
    classes = {r.doc_id: (r.class_id, r.class_size, r.class_texts) for r in probminhash.classes_of(docs).collect()}
    assert classes == {1: (1, 3, 2), 2: (1, 3, 2), 3: (1, 3, 2), 4: (4, 1, 1), 5: (5, 1, 1)}
    near = {r.doc_id: r.near for r in fingerprint.with_next(docs, "doc_id", "text", 3).select("doc_id", fingerprint.likeness(F.col("__fp"), F.col("__fp_next")).alias("near")).collect()}
    assert near[2] == 1.0 and 0.99 < near[3] < 1.0 and near[5] < 0.2


def test_ids_and_scores_of_long_texts(long_docs):
    text, docs = long_docs
    rows = {r.doc_id: r for r in pieces.digests(docs, pieces.model()).collect()}
    assert rows[1].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest() and rows[1].n_bytes == len(text.encode())
    packed = packing.pack(docs, packing.vocabulary())
    sums = {r.doc_id: (r.n, r.least) for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.min("start").alias("least")).collect()}
    assert sums[1] == sums[2] and sums[1][0] > 400_000 and sums[5][0] == 2 and {v[1] for v in sums.values()} == {0}
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").isEmpty()
    model = toxicity.train([text[:2000], "bad words here bad"] * 5, [0, 1] * 5)
    assert all(0 <= r["__tx_score"] <= 1 for r in toxicity.scored(docs, model).collect())
