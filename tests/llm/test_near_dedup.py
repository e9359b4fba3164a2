import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import probminhash as pm

WORD = re.compile(rb"[0-9A-Za-z_\x80-\xff]+")


def plain_set(t):
    w = WORD.findall((t or "").lower().encode())
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset([("raw", t or "")])


def plain_classes(rows):
    sets = {i: plain_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and both / (len(sets[i]) + len(sets[j]) - both) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_shingles_and_similarity_equal_plain_sets(texts):
    owner, h, counts, nodes = pm.shingles([t or "" for t in texts])
    for i, t in enumerate(texts):
        want = plain_set(t)
        assert (owner == i).sum() == (0 if any(x[0] == "raw" for x in want) else len(want))
    a, b = (h[owner == i].tobytes() for i in (6, 10))
    x, y = plain_set(texts[6]), plain_set(texts[10])
    assert pm.similarity(a, b) == pytest.approx(len(x & y) / len(x | y))


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    x, y = {int(k): int(rng.integers(1, 4)) for k in range(0, 700)}, {int(k): int(rng.integers(1, 4)) for k in range(150, 800)}
    w = lambda d: {k: 1 + np.log(v) for k, v in d.items()}
    wx, wy = w(x), w(y)
    ks = sorted(set(wx) | set(wy))
    a, b = np.array([wx.get(k, 0) for k in ks]), np.array([wy.get(k, 0) for k in ks])
    exact = sum(1 / np.maximum(a / a[i], b / b[i]).sum() for i in range(len(ks)) if a[i] and b[i])
    got = []
    for salt in range(12):
        parts = [(np.full(len(d), i), pm.mix(np.array(sorted(d), pm.U) + pm.U(salt * 10**6)), np.array([d[k] for k in sorted(d)])) for i, d in enumerate((x, y))]
        s = pm.signatures(*(np.concatenate(c) for c in zip(*parts)), 2)
        got.append((s[0] == s[1]).mean())
    assert np.mean(got) == pytest.approx(exact, abs=0.05)


def planted(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    shared = [word() for _ in range(60)]
    texts = []
    for g in range(12):
        base = [word() for _ in range(rng.choice([8, 60, 200]))]
        texts.append(base)
        for _ in range(rng.choice([0, 3, 25])):
            copy = list(base)
            for _ in range(max(1, len(base) // rng.choice([20, 40, 120]))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(copy)
    texts += [[word() for _ in range(40)] + shared + [word() for _ in range(rng.randrange(40))] for _ in range(60)]
    out = [" ".join(t) for t in texts]
    out += [out[0].upper() + "!", out[0], "", "", "?", None]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("block", [2048, 3])
def test_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(pm, "BLOCK", block)
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in pm.classes_of(df).collect()}
    want = plain_classes(rows)
    assert got == want


def repeated(seed=5):
    """Pairs at 0.8 or a little more, where one text says a passage up to a thousand times and the other once."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    out = []
    for times in (10, 100, 1000):
        for _ in range(12):
            base, passage = [word() for _ in range(160)], [word() for _ in range(36)]
            out += [" ".join(base + passage), " ".join(base + passage * times + [word() for _ in range(36)])]
    out += [" ".join([word() for _ in range(160)] + out[1].split()[160:196] * 50) for _ in range(6)]  # the passage alone makes no link
    return list(enumerate(out))


def test_a_passage_repeated_in_one_copy_hides_no_pair(spark):
    rows = repeated()
    want = plain_classes(rows)
    assert sum(i != c for i, c in want.items()) == 36
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.class_id for r in pm.classes_of(df).collect()} == want


def test_every_pair_of_the_query_rows_is_in_one_class(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in pm.classes_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    by_shingle, sets = defaultdict(list), {i: plain_set(t) for i, t in rows}
    for i, x in sets.items():
        for g in x:
            by_shingle[g].append(i)
    pairs = missed = 0
    for q in (i for i in sets if i % 100 == 0):
        for j in {j for g in sets[q] for j in by_shingle[g]} - {q}:
            both = len(sets[q] & sets[j])
            if both / (len(sets[q]) + len(sets[j]) - both) >= 0.8:
                pairs += 1
                missed += got[q].class_id != got[j].class_id
    assert pairs >= 10 and missed <= 0.01 * pairs, (missed, pairs)
    texts = defaultdict(set)
    for i, r in got.items():
        texts[r.class_id].add((sets[i]))
    for r in got.values():
        assert r.class_texts >= len(texts[r.class_id]) and (r.links > 0) == (r.class_texts > 1)


def test_what_the_sketch_may_lose():
    import math

    n = pm.REGISTERS
    assert sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(math.ceil(pm.SKETCH_LEAST * n))) < 1e-17
    assert (1 - 0.8**pm.ROWS) ** pm.BANDS < 4e-6


def test_stage_keeps_one_row_of_each_class(docs, empty, texts):
    more = docs.withColumn("node", F.lit(1)).withColumn("salt", F.lit(2)).withColumn("th", F.lit(3))
    out = pm.keep_one(more)
    rows = out.collect()
    classes = plain_classes([(i, t) for i, t in enumerate(texts)])
    assert out.columns == more.columns
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(set(classes.values())) and sum(r.doc_id is None for r in rows) == 1
    assert pm.keep_one(empty).count() == 0


def test_search_joins_only_across_classes_and_sides():
    import pandas as pd

    sets = [np.sort(pm.mix(np.arange(100, dtype=pm.U) + pm.U(k))).tobytes() for k in (0, 1, 2)]
    sketch = [np.zeros(pm.REGISTERS, "<u2").tobytes()] * 3
    rows = pd.DataFrame({"node": [b"a", b"b", b"c"], "set": sets, "sketch": sketch, "class": [b"a", b"b", b"b"], "side": [2, 2, 2]})
    assert len(pm.search(rows)) == 1 and pm.search(rows.assign(side=[0, 0, 0])).empty and pm.search(rows.assign(**{"class": b"z"})).empty


def test_components(spark):
    edges = [(a, a + 1) for a in range(30)] + [(100, 200), (300, 200), (7, 7)] + [(500, k) for k in range(501, 540)]
    got = defaultdict(set)
    for r in pm.components(spark.createDataFrame([(f"{a:04d}", f"{b:04d}") for a, b in edges], "a string, b string")).collect():
        got[r["class"]].add(int(r["node"]))
    assert {int(k): len(v) for k, v in got.items()} == {0: 31, 100: 3, 500: 40}
