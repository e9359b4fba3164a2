import hashlib
import math
import random
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from gridloom.llm import fingerprint as fp


def _hash(*parts):
    h = 42
    for p in parts:
        h = xxhash.xxh64(p.encode(), seed=h).intdigest()
    return h


def _features(para):
    out = []
    for clause in re.split(r"(?<=[!-/:-@\[-`{-~dykgzx])[ \t]+", para):
        if len(clause) <= fp.LONG:
            out.append(_hash(clause))
            continue
        words = re.split(r"[ \t\n\x0b\f\r]+", clause)
        out += [_hash(w, words[i + 1] if i + 1 < len(words) else "") for i, w in enumerate(words)]
        out += [_hash(*w[i : i + fp.GRAM]) for w in words if len(w) > fp.LONG for i in range(len(w) - fp.GRAM + 1)]
    return out


def twin(text):
    """The fingerprint by plain loops: dense lanes, and the sums of the others."""
    dense, lanes = [0] * fp.WIDE, Counter()
    for para in (p.strip(" ") for p in re.split(r"[\r\n]+", text or "")):
        if para:
            digest = hashlib.sha256(para.encode()).hexdigest()
            dense = [(d + int(digest[16 * i : 16 * i + 15], 16)) % fp.DENSE_MOD for i, d in enumerate(dense)]
            for h, n in Counter(_features(para)).items():
                lanes[h >> 54] += (1 if h >> 40 & 1 else -1) * round(fp.SCALE * math.sqrt(n))
    return dense, {k: v for k, v in lanes.items() if v}


def cosine(x, y):
    norms = math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values()))
    return min(1.0, max(0.0, sum(v * y.get(k, 0) for k, v in x.items()) / norms)) if norms else 0.0


def test_vectors_and_likeness_equal_the_plain_loops(spark, texts):
    rng = random.Random(3)
    more = [t for t in texts if t and len(t) < 5000]
    cases = [*texts, *("\n".join(rng.choice(more)[: rng.randrange(1, 900)] for _ in range(rng.randrange(1, 6))) for _ in range(40)), "same. same. same. same. other, same. " * 9]
    df = spark.createDataFrame([(i, t or "", cases[i - 1] or "") for i, t in enumerate(cases)], "i int, x string, y string")
    f = {k: fp.fingerprint(F.col(k)) for k in "xy"}
    rows = df.select("i", f["x"].alias("f"), fp.likeness(f["x"], f["y"]).alias("near"), fp.text_form(f["x"]).alias("form")).collect()
    assert len(rows) == len(cases)
    for r in rows:
        (dense, lanes), (other, theirs) = twin(cases[r.i]), twin(cases[r.i - 1])
        signed = {e >> fp.SUM_BITS: (v := e & fp.SUM_MASK) - (v >> 39 << 40) for e in r.f.lanes}
        assert (list(r.f.dense), signed) == (dense, lanes), r.i
        assert list(r.f.lanes) == sorted(r.f.lanes) and r.form == "".join(f"{d:015x}" for d in dense) + ":" + ",".join(map(str, r.f.lanes))
        assert abs(r.near - (1.0 if dense == other else cosine(lanes, theirs))) < 1e-9, r.i


def test_edits_of_a_twentieth_stay_near_at_any_length(spark):
    rng = random.Random(11)
    signs = [chr(rng.randrange(0x4E00, 0x9000)) for _ in range(3000)]
    changed = signs[:1400] + [chr(rng.randrange(0x4E00, 0x9000)) for _ in range(100)] + signs[1500:]
    clause = lambda low: F.concat_ws(", ", F.transform(F.sequence(F.lit(0), F.lit(599_999)), lambda i: F.concat(F.lit("clause "), F.when(i < low, -i).otherwise(i).cast("string"))))
    df = spark.createDataFrame([("".join(signs), "".join(changed))], "x string, y string").unionByName(spark.range(1).select(clause(0).alias("x"), clause(30_000).alias("y")))
    near = [r.n for r in df.select(fp.likeness(fp.fingerprint(F.col("x")), fp.fingerprint(F.col("y"))).alias("n")).collect()]
    assert len(near) == 2 and all(0.85 < n < 1 for n in near), near


def test_columns_with_inner_names_pass(spark):
    df = spark.createDataFrame([(2, "b b."), (1, "a a."), (None, None)], "r long, last string")
    rows = fp.with_next(df, "r", "last", 2).select("r", "__fp_text", "__fp_next_text").collect()
    assert sorted((r.r or 0, r["__fp_text"], r["__fp_next_text"]) for r in rows) == [(0, "", "b b."), (1, "a a.", ""), (2, "b b.", "a a.")]


def test_next_and_edited_texts_equal_the_plain_loop(spark, texts):
    for ranges in (1, 3, 8, 40):
        df = spark.createDataFrame([(i * 7, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
        rows = {r.doc_id: r for r in fp.with_next(df, "doc_id", "text", ranges).withColumn("e", fp.edited(F.col("__fp_text"), F.col("__fp_next_text"))).select("doc_id", "__fp_text", "__fp_next_text", "e").collect()}
        assert len(rows) == len(texts)
        for i, t in enumerate(texts):
            own, after = t or "", texts[i - 1] or ""
            third = len(own) // 3
            assert (rows[i * 7]["__fp_text"], rows[i * 7]["__fp_next_text"]) == (own, after)
            assert rows[i * 7].e == own[: len(own) - third] + after[:third]


def test_order_and_incremental_updates(spark):
    a, b, c = "First one. With words, many.", "Second paragraph here!", "Third; and last"
    df = spark.createDataFrame([("\n".join((a, b, c)), "\n\n".join((c, a, b)), "\n".join((a, c)), b, "\n".join((a, b, b, c)))], "x string, y string, ac string, b string, abbc string")
    f = {k: fp.fingerprint(F.col(k)) for k in df.columns}
    r = df.select(*[(x).alias(n) for n, x in {
        "order": f["x"] == f["y"], "insert": fp.add(f["ac"], f["b"]) == f["x"], "delete": fp.subtract(f["x"], f["b"]) == f["ac"], "count": f["x"] == f["abbc"],
        "same": fp.likeness(f["x"], f["y"]), "less": fp.likeness(f["x"], f["ac"])}.items()]).first()
    assert r.order and r.insert and r["delete"] and not r["count"] and r.same == 1.0 and 0 < r.less < 1


def test_equal_texts_and_only_those(docs):
    rows = fp.with_next(docs, "doc_id", "text").select("__fp_text", fp.text_form(F.col("__fp")).alias("f"), fp.likeness(F.col("__fp"), F.col("__fp_next")).alias("n")).collect()
    by = {}
    for r in rows:
        by.setdefault(r.f, set()).add("\n".join(sorted(p.strip(" ") for p in r["__fp_text"].splitlines() if p.strip(" "))))
        assert 0 <= r.n <= 1
    assert len(rows) == docs.count() and all(len(v) == 1 for v in by.values())


def test_single_and_empty_tables(spark, empty):
    one = spark.createDataFrame([(5, "abc def")], "doc_id long, text string")
    assert fp.with_next(one, "doc_id", "text").first()["__fp_next_text"] == "abc def"
    assert fp.with_next(empty, "doc_id", "text").count() == 0


def test_edits_stay_near(spark):
    rows = fp.op5_fingerprints(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and {r.fingerprint.index(":") for r in rows} == {15 * fp.WIDE}
    near = [r for r in rows if r.n_chars >= 200]
    assert sum(r.near_edited > r.near_next for r in near) >= 0.93 * len(near)
    assert rows[0].edited_sha256 != hashlib.sha256(b"").hexdigest()


def test_every_edited_text_is_like_its_own(spark):
    one = " ".join(["Ndtion"] * 2700)
    prose = " ".join(f"word{i}n than{i}e" for i in range(1500))
    cases = [(one, prose), (prose, one), ("\u6f22\u5b57\u304b\u306a" * 900 + "".join(chr(0x4E00 + i) for i in range(3000)), prose), ("\n".join(f"line {i} of many, and more." for i in range(3000)), one)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(cases)], "i int, x string, y string").withColumn("e", fp.edited(F.col("x"), F.col("y")))
    f = {k: fp.fingerprint(F.col(k)) for k in "xye"}
    for r in df.select("i", fp.likeness(f["x"], f["e"]).alias("near"), fp.likeness(f["x"], f["y"]).alias("far")).collect():
        assert r.near > 0.35 and r.far < 0.2, r
