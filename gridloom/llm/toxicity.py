"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples P and texts taken as unlabelled U train a linear numpy classifier on
word and word-beginning features, weighed by the logarithm of their counts. P are documents
whose label is toxic; U are any documents, most of them without a label, and their labels are
not used: no label that says "not toxic" is ever read. With the class prior pi the risk is

    pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))

with the logistic loss; where the estimate of the negative part falls below zero, a step
ascends that part instead, which keeps a flexible model from driving it negative. A
penalty on absolute weights leaves most features without one.

pi comes from P and U alone: models with the starting value ``PRIOR`` score the fold they were
not trained on, and the share of U above a score over the share of P above it, at the score
where its upper confidence bound is smallest, is the estimate (best bin estimation). With
fewer than ``FEWEST`` confirmed examples it stays ``PRIOR``.

Training takes at most ``MOST_TOXIC`` and ``MOST_ANY`` documents, those with the least hashes
of their ids, so its cost and the model's size don't grow with the table. Executors turn them
into hashed counts, at most ``WIDE`` a document; only these reach the driver, never texts.

Scoring is one pass over whole texts; the model is a table of at most ``VOCABULARY`` weights.
Ids, languages, sources and labels are never inputs of a score.

Defined cases: null texts count as empty and score as a text without features; null labels
and null ids aren't learnt from; repeated ids count once each, with the least of their texts;
without any toxic row among the labels every score is 0; an empty table gives an empty
result; other columns pass through the filter.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import materialise, table

MOST_TOXIC, MOST_ANY, WIDE, VOCABULARY, LEAST_DOCS, THRESHOLD = 1_200, 3_000, 8_192, 50_000, 4, 0.3
STEPS, RATE, SPARSITY, BETA = 150, 0.05, 1e-3, 0.0
PRIOR, FOLDS, FOLD_STEPS, FEWEST, DELTA = 0.1, 4, 100, 20, 0.1
BEGINNINGS = (4, 5, 6, 7)
WORD = re.compile(r"\w+")
Vector = tuple[np.ndarray, np.ndarray]


def features_of(word: str) -> list[int]:
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in (word, *(f"<{word[:n]}" for n in BEGINNINGS if len(word) > n))]


def counts_of(text: str) -> Counter[str]:
    return Counter(WORD.findall(text.lower()))


class Model:
    """Weights by feature; contributions of words are looked up once each."""

    def __init__(self, weights: dict[int, float], bias: float, prior: float = 0.0):
        self.weights, self.bias, self.prior = weights, bias, prior
        self.known: dict[str, tuple[int, ...]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def score(self, text: str) -> float:
        if not self.weights:
            return 0.0
        totals: Counter[int] = Counter()
        for word, n in counts_of(text).items():
            found = self.known.get(word)
            if found is None:
                if len(self.known) > 500_000:
                    self.known.clear()
                found = self.known[word] = tuple(f for f in features_of(word) if f in self.weights)
            for f in found:
                totals[f] += n
        z = self.bias + sum(self.weights[f] * math.log1p(totals[f]) for f in sorted(totals))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def vector(text: str) -> Vector:
    """Hashed features of a text in order, and the logarithms of their counts; of more than WIDE those with the least hashes."""
    totals: Counter[int] = Counter()
    for word, n in counts_of(text).items():
        for f in features_of(word):
            totals[f] += n
    names = np.fromiter(totals.keys(), np.uint32, len(totals))
    values = np.log1p(np.fromiter(totals.values(), np.float32, len(totals)))
    order = np.argsort(names, kind="stable")[:WIDE]
    return names[order], values[order]


class Matrix:
    """Vectors over the features of LEAST_DOCS vectors or more (the VOCABULARY most spread ones), by rows and by columns.

    Places take 4 bytes and values 4, twice; products are made in single precision.
    """

    def __init__(self, vectors: list[Vector]):
        self.n = len(vectors)
        names, spread = np.unique(np.concatenate([v[0] for v in vectors] or [np.zeros(0, np.uint32)]), return_counts=True)
        chosen = np.lexsort((names, -spread))
        chosen = chosen[spread[chosen] >= LEAST_DOCS][:VOCABULARY]
        self.names = np.sort(names[chosen])
        cols, values = [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
        for own, v in vectors if len(self.names) else ():
            at = np.minimum(np.searchsorted(self.names, own), len(self.names) - 1).astype(np.int32)
            used = self.names[at] == own
            cols.append(at[used])
            values.append(v[used])
        lengths = np.array([len(c) for c in cols[1:]] or [0] * self.n, np.int64)
        self.cols, self.values = np.concatenate(cols), np.concatenate(values)
        self.some = np.flatnonzero(lengths)  # rows with features, and where they begin
        self.starts = (np.cumsum(lengths) - lengths)[self.some]
        turned = np.argsort(self.cols, kind="stable").astype(np.int32)
        self.turned_rows, self.turned_values = np.repeat(np.arange(self.n, dtype=np.int32), lengths)[turned], self.values[turned]
        self.col_starts = np.searchsorted(self.cols[turned], np.arange(len(self.names)))

    def times(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        if len(self.some):
            products = weights.astype(np.float32)[self.cols]
            products *= self.values
            out[self.some] = np.add.reduceat(products, self.starts)
        return out

    def turned_times(self, by_row: np.ndarray) -> np.ndarray:
        if not len(self.names):
            return np.zeros(0)
        products = by_row.astype(np.float32)[self.turned_rows]
        products *= self.turned_values
        return np.add.reduceat(products, self.col_starts).astype(float)


def risk(z: np.ndarray, share_p: np.ndarray, share_u: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
    """The positive part, the negative part before max(0, ...), and their gradients by the outputs z.

    share_p holds pi / n_p for members of P, share_u 1 / n_u for members of U, and 0 elsewhere.
    """
    s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    loss_negative = np.logaddexp(0, z)
    return float(share_p @ np.logaddexp(0, -z)), float((share_u - share_p) @ loss_negative), share_p * (s - 1), (share_u - share_p) * s


def descend(x: Matrix, in_p: np.ndarray, in_u: np.ndarray, prior: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and bias after steps of Adam with soft thresholds on the non-negative risk."""
    width = len(x.names)
    w, b = np.zeros(width), math.log(prior / (1 - prior))
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0
    share_p, share_u = prior * in_p / max(1, in_p.sum()), in_u / max(1, in_u.sum())
    for step in range(1, steps + 1):
        _, negative, grad_positive, grad_negative = risk(x.times(w) + b, share_p, share_u)
        g = -grad_negative if negative < -BETA else grad_positive + grad_negative
        gw, gb = x.turned_times(g), float(g.sum())
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c, d = 1 - 0.9**step, 1 - 0.999**step
        pace = RATE / (np.sqrt(v / d) + 1e-6)
        w -= pace * (m / c)
        w = np.sign(w) * np.maximum(np.abs(w) - pace * SPARSITY, 0)  # most words keep no weight
        b -= RATE * (mb / c) / (math.sqrt(vb / d) + 1e-6)
    return w, b


def best_bin(p: np.ndarray, u: np.ndarray) -> float:
    """The share of P's kind in U from scores of both: U's share above a score over P's, where its upper bound is least."""
    at = np.unique(p)
    above_p = 1 - np.searchsorted(np.sort(p), at) / len(p)
    above_u = 1 - np.searchsorted(np.sort(u), at) / len(u)
    slack = sum(math.sqrt(math.log(4 / DELTA) / (2 * len(k))) for k in (p, u))
    i = int(np.argmin((above_u + slack) / above_p))
    return float(min(0.5, max(0.001, above_u[i] / above_p[i])))


def estimated_prior(x: Matrix, in_p: np.ndarray, in_u: np.ndarray) -> float:
    if in_p.sum() < FEWEST:
        return PRIOR
    # Members of P and of U go round the folds apart, so each fold has its share of both.
    fold = np.where(in_p, np.cumsum(in_p), np.cumsum(in_u)) % FOLDS
    scores = np.zeros(x.n)
    for k in range(FOLDS):
        out = fold == k
        w, b = descend(x, in_p & ~out, in_u & ~out, PRIOR, FOLD_STEPS)
        scores[out] = (x.times(w) + b)[out]
    return best_bin(scores[in_p], scores[in_u])


def train_on(x: Matrix, toxic: int, steps: int = STEPS) -> Model:
    """Fits P = the first ``toxic`` rows against U = the others."""
    if not toxic:
        return Model({}, 0.0)
    in_p = np.arange(x.n) < toxic
    in_u = ~in_p
    prior = estimated_prior(x, in_p, in_u)
    w, b = descend(x, in_p, in_u, prior, steps)
    return Model({int(x.names[i]): round(float(w[i]), 6) for i in np.flatnonzero(np.abs(w) > 1e-4)}, b, prior)


def train(texts: list[str], toxic: list[int], steps: int = STEPS) -> Model:
    """Fits P = texts with toxic 1 against U = all texts, in memory."""
    vectors = [vector(t) for t in texts]
    chosen = [v for v, y in zip(vectors, toxic, strict=True) if y == 1]
    return train_on(Matrix([*chosen, *vectors]), len(chosen), steps)


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def least_hashed(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` ids (column __tx_id) of the least hashes, each once, or all if there are fewer.

    Ids of the least 8 * most hashes' share meet first, so that the table's ids aren't all dealt out;
    only where few ids are repeated over most rows, and too few came, all of them do.
    """
    h, n = F.xxhash64("__tx_id"), rows.count()
    chosen = lambda some: materialise(some.distinct().orderBy(h, "__tx_id").limit(most), "sample")
    if n > 8 * most:
        few = chosen(rows.filter(h < F.lit(-(1 << 63) + (1 << 67) * most // n)))
        if few.count() == most:
            return few
    return chosen(rows)


def learnt_from(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_any: int = MOST_ANY) -> DataFrame:
    """(doc_id, p, u, names, values): the vectors of P and U outside the held-out quarter, a row for each id."""
    ids = lambda rows: rows.select(F.col("doc_id").alias("__tx_id")).filter(F.col("__tx_id").isNotNull() & ~held_out(F.col("__tx_id")))
    p = least_hashed(ids(labels.filter("toxic = 1")), most_toxic).select("__tx_id", F.lit(True).alias("p"))
    u = least_hashed(ids(docs), most_any).select("__tx_id", F.lit(True).alias("u"))
    chosen = p.join(u, "__tx_id", "full").select("__tx_id", F.coalesce("p", F.lit(False)).alias("p"), F.coalesce("u", F.lit(False)).alias("u"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("__tx_text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("__tx_id"))  # at most most_toxic + most_any ids
    once = texts.groupBy("doc_id").agg(F.min("__tx_text").alias("__tx_text"), F.bool_or("p").alias("p"), F.bool_or("u").alias("u"))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [vector(t) for t in batch["__tx_text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "p": batch["p"], "u": batch["u"], "names": [r[0].astype("<u4").tobytes() for r in rows], "vals": [r[1].astype("<f4").tobytes() for r in rows]})

    return once.mapInPandas(vectors, "doc_id long, p boolean, u boolean, names binary, vals binary")


def fit(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_any: int = MOST_ANY) -> Model:
    """Trains on bounded samples; the driver gets a hashed vector for each document of these."""
    rows = learnt_from(docs, labels, most_toxic, most_any).toArrow()
    order = np.argsort(rows["doc_id"].to_numpy()).tolist()
    names, values, p, u = (rows[c] for c in ("names", "vals", "p", "u"))
    some = [*(i for i in order if p[i].as_py()), *(i for i in order if u[i].as_py())]
    toxic = sum(x.as_py() for x in p)
    x = Matrix([(np.frombuffer(names[i].as_buffer(), "<u4"), np.frombuffer(values[i].as_buffer(), "<f4")) for i in some])
    del rows, names, values  # the matrix is all that training needs
    return train_on(x, toxic)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with __tx_score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most VOCABULARY weights

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(shared.value.weights, shared.value.bias)
        for texts in batches:
            yield pd.Series([own.score(t) for t in texts], dtype="float64")

    return docs.withColumn("__tx_score", score(F.coalesce(F.col(text_col), F.lit(""))))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    s = F.round("__tx_score", 9)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), s.alias("score"), (s >= THRESHOLD).cast("int").alias("predicted"))
