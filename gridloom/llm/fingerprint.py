r"""Document fingerprints: a homomorphic multiset hash over paragraphs, on DataFrame functions alone.

Every paragraph (a line that isn't blank) becomes a wide vector; a text's fingerprint is
the sum of its paragraphs' vectors modulo powers of two. So equal multisets of paragraphs
have equal fingerprints in any order, and a paragraph is inserted or deleted by adding or
subtracting its vector (``add``, ``subtract``) without the rest of the text.

The vector has two parts:

* ``dense``: ``WIDE`` lanes modulo 2**60 cut from a SHA-256 of the paragraph. They carry equality.
* ``lanes``: ``LANES`` sums modulo 2**40, a count sketch. Of the paragraph's features each adds its
  weight, with a hashed sign, to one hashed lane. They carry likeness. Lanes that are zero are left
  out, so a short text is a short list: each entry is a lane's number above 40 bits of its sum.

Features are clauses, cut behind punctuation and behind words that end in a rarer letter; a clause
of more than ``LONG`` characters gives its pairs of neighbouring words instead, and a word of more
than ``LONG`` also every run of ``GRAM`` characters. So a feature depends on nearby characters
alone and no line is a single one. A feature that a paragraph holds n times weighs sqrt(n) (times
``SCALE``, rounded), so that its share of the square norm is its share of the paragraph.

Likeness of two fingerprints is the cosine of their lanes, 0 where that is negative: all features
of a text of any length count, its standard error is about 1 / sqrt(``LANES``) and a text is like
the same text repeated. Equal texts have likeness 1.

The next document comes by descending id, and after the last the first. Rows are dealt
into ranges of ids with bounds from quantiles, four for each shuffle partition; the first row of each range also travels
to the range before it, so one shuffle suffices and no window spans the table.

Defined cases: null texts count as empty (no paragraph, the zero fingerprint; two empty
texts have likeness 1); null ids come last; rows that repeat an id follow each other by
their texts; a single document is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import let, table, whole_text

WIDE, LANE_BITS, LONG, GRAM, SCALE = 4, 10, 64, 8, 8
LANES, DENSE_MOD, SUM_BITS = 1 << LANE_BITS, 1 << 60, 40
SUM_MASK = (1 << SUM_BITS) - 1
CUT = r"(?<=[\p{Punct}dykgzx])[\x20\t]+"


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"[\r\n]+"), lambda p: F.trim(p)), lambda p: p != "")


def dense_of(paras: Column) -> Column:
    hashed = F.transform(paras, lambda p: F.sha2(p, 256))
    return let(hashed, lambda hs: F.transform(F.sequence(F.lit(0), F.lit(WIDE - 1)), lambda lane: F.aggregate(hs, F.lit(0).cast("long"), lambda a, h: (a + F.conv(F.substr(h, lane * 16 + 1, F.lit(15)), 16, 10).cast("long")) % DENSE_MOD)))


def features(para: Column) -> Column:
    """The hash of every feature of a paragraph."""
    def grams(word: Column) -> Column:
        return let(F.split(word, ""), lambda c: F.transform(F.sequence(F.lit(1), F.size(c) - (GRAM - 1)), lambda i: F.xxhash64(F.slice(c, i, F.lit(GRAM)))))

    def pairs(words: Column) -> Column:
        both = F.transform(words, lambda w, i: F.xxhash64(w, F.coalesce(F.get(words, i + 1), F.lit(""))))
        return F.concat(both, F.flatten(F.transform(F.filter(words, lambda w: F.length(w) > LONG), grams)))

    def mixed(clauses: Column) -> Column:
        return F.flatten(F.transform(clauses, lambda c: F.when(F.length(c) <= LONG, F.array(F.xxhash64(c))).otherwise(let(F.split(c, r"\s+"), pairs))))

    return let(F.split(para, CUT), lambda cs: F.when(F.exists(cs, lambda c: F.length(c) > LONG), mixed(cs)).otherwise(F.transform(cs, lambda c: F.xxhash64(c))))


def entry(h: Column, weight: Column) -> Column:
    """A feature's lane, from its hash's high bits, above its weight modulo 2**40, whose sign is the hash's bit 40."""
    signed = F.when(F.getbit(h, F.lit(40)) == 1, weight).otherwise(-weight)
    return F.shiftleft(F.shiftrightunsigned(h, 64 - LANE_BITS), SUM_BITS).bitwiseOR(signed.bitwiseAND(F.lit(SUM_MASK)))


def entries(para: Column) -> Column:
    """An entry for each different feature of a paragraph."""
    def runs(h: Column) -> Column:
        starts = F.array_compact(F.transform(h, lambda x, i: F.when((i == 0) | (x != F.get(h, i - 1)), i)))
        return let(starts, lambda s: F.transform(s, lambda at, k: entry(F.get(h, at), F.round(SCALE * F.sqrt(F.coalesce(F.get(s, k + 1), F.size(h)) - at)).cast("long"))))

    plain = F.lit(SCALE).cast("long")
    return let(features(para), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.transform(h, lambda x: entry(x, plain))).otherwise(let(F.sort_array(h), runs)))


def merged(some: Column) -> Column:
    """One entry for each lane whose sum isn't zero, by lane."""
    def lane(e: Column) -> Column:
        return F.shiftright(e, SUM_BITS)

    def total(es: Column, at: Column, end: Column) -> Column:
        added = F.aggregate(F.slice(es, at + 1, end - at), F.lit(0).cast("long"), lambda a, e: (a + e.bitwiseAND(F.lit(SUM_MASK))).bitwiseAND(F.lit(SUM_MASK)))
        return F.when(end - at == 1, F.get(es, at)).otherwise(F.shiftleft(lane(F.get(es, at)), SUM_BITS).bitwiseOR(added))

    def sums(es: Column) -> Column:
        starts = F.array_compact(F.transform(es, lambda e, i: F.when((i == 0) | (lane(e) != lane(F.get(es, i - 1))), i)))
        return let(starts, lambda s: F.transform(s, lambda at, k: let(F.coalesce(F.get(s, k + 1), F.size(es)), lambda end: total(es, at, end))))

    return F.filter(let(F.sort_array(some), sums), lambda e: e.bitwiseAND(F.lit(SUM_MASK)) != 0)


def lanes_of(paras: Column) -> Column:
    return merged(F.flatten(F.transform(paras, entries)))


def fingerprint(text: Column) -> Column:
    """struct<dense: array<long>, lanes: array<long>> of a text that isn't null."""
    return let(paragraphs(text), lambda p: F.struct(dense_of(p).alias("dense"), lanes_of(p).alias("lanes")))


def _combined(a: Column, b: Column, sign: int) -> Column:
    other = b["lanes"] if sign > 0 else F.transform(b["lanes"], lambda e: e.bitwiseAND(F.lit(-1 - SUM_MASK)).bitwiseOR((-e.bitwiseAND(F.lit(SUM_MASK))).bitwiseAND(F.lit(SUM_MASK))))
    return F.struct(
        F.zip_with(a["dense"], b["dense"], lambda x, y: F.pmod(x + sign * y, F.lit(DENSE_MOD))).alias("dense"),
        merged(F.concat(a["lanes"], other)).alias("lanes"),
    )


def add(a: Column, b: Column) -> Column:
    """The fingerprint of the texts of a and b together."""
    return _combined(a, b, 1)


def subtract(a: Column, b: Column) -> Column:
    """The fingerprint of a without the paragraphs of b."""
    return _combined(a, b, -1)


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the lanes, 0 to 1; 1 where the fingerprints are equal."""
    def value(e: Column) -> Column:
        return F.shiftright(F.shiftleft(e, 64 - SUM_BITS), 64 - SUM_BITS).cast("double")

    def norm(x: Column) -> Column:
        return F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, e: s + value(e) * value(e)))

    def dot(x: Column, y: Column) -> Column:
        by_lane = F.map_from_arrays(F.transform(y, lambda e: F.shiftright(e, SUM_BITS)), F.transform(y, value))
        return let(by_lane, lambda m: F.aggregate(x, F.lit(0.0), lambda s, e: s + value(e) * F.coalesce(F.try_element_at(m, F.shiftright(e, SUM_BITS)), F.lit(0.0))))

    def cosine(p: Column) -> Column:
        return let(norm(p["x"]) * norm(p["y"]), lambda n: F.when(n == 0, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(p["x"], p["y"]) / n))))

    return F.when(a["dense"] == b["dense"], 1.0).otherwise(let(F.struct(a["lanes"].alias("x"), b["lanes"].alias("y")), cosine))


def text_form(f: Column) -> Column:
    """Dense lanes in hex, a colon, and the entries of the others as decimals."""
    dense = F.lower(F.array_join(F.transform(f["dense"], lambda v: F.lpad(F.hex(v), 15, "0")), ""))
    return F.concat(dense, F.lit(":"), F.array_join(f["lanes"].cast("array<string>"), ","))


def with_next(docs: DataFrame, id_col: str, text_col: str, ranges: int | None = None) -> DataFrame:
    """Rows (id, __fp_text, __fp, __fp_next_text, __fp_next): every document beside the next by descending id.

    The driver gets the bounds and the largest id of each range, as many as four times the shuffle
    partitions; they go back as one row of arrays.
    """
    spark = docs.sparkSession
    n = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    keys = docs.select(key.alias("__fp_key"))
    bounds = keys.agg(F.percentile_approx("__fp_key", [i / n for i in range(1, n)], max(10_000, 4 * n)).alias("b")).first()["b"] if n > 1 else []
    bounds = sorted(set(bounds or []))
    step = max(1, int(len(bounds) ** 0.5))
    cut = spark.createDataFrame([(bounds[step - 1 :: step], bounds)], "__fp_coarse array<long>, __fp_fine array<long>")

    def range_of(k: Column) -> Column:
        """How many bounds are at most k: whole steps first, then within one."""
        whole = F.size(F.filter("__fp_coarse", lambda x: x <= k)) * step
        return let(whole, lambda w: w + F.size(F.filter(F.slice("__fp_fine", w + 1, F.lit(step)), lambda x: x <= k)))

    heads = {r["r"]: r["h"] for r in keys.crossJoin(F.broadcast(cut)).groupBy(range_of(F.col("__fp_key")).alias("r")).agg(F.max("__fp_key").alias("h")).collect()}
    filled = sorted(heads, reverse=True)
    span = range(len(bounds) + 1)
    goes_to = {r: filled[i - 1] for i, r in enumerate(filled)}  # the range before a range's own, cyclic
    ends = spark.createDataFrame([([heads.get(r) for r in span], [goes_to.get(r) for r in span])], "__fp_heads array<long>, __fp_before array<int>")
    rows = docs.select(F.col(id_col).alias("__fp_id"), key.alias("__fp_key"), whole_text(F.col(text_col)).alias("__fp_text"))

    def seats(r: Column) -> Column:
        own = F.struct(r.alias("__fp_r"), F.lit(False).alias("__fp_last"), F.lit(False).alias("__fp_guest"))
        guest = F.struct(F.element_at("__fp_before", r + 1).alias("__fp_r"), (r == (filled[0] if filled else 0)).alias("__fp_last"), F.lit(True).alias("__fp_guest"))
        return F.when(F.element_at("__fp_heads", r + 1) == F.col("__fp_key"), F.array(own, guest)).otherwise(F.array(own))

    placed = rows.crossJoin(F.broadcast(cut)).crossJoin(F.broadcast(ends))  # two sides of one row each
    dealt = placed.withColumn("__fp_at", F.explode(let(range_of(F.col("__fp_key")), seats))).select("__fp_id", "__fp_key", "__fp_text", "__fp_at.*")
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "__fp_r").withColumn("__fp", fingerprint(F.col("__fp_text")))
    order = Window.partitionBy("__fp_r").orderBy("__fp_last", F.desc("__fp_key"), "__fp_guest", "__fp_text")
    return (
        dealt.withColumn("__fp_follows", F.lead(F.struct("__fp_text", "__fp")).over(order)).filter(~F.col("__fp_guest"))
        .select(F.col("__fp_id").alias(id_col), "__fp_text", "__fp", F.col("__fp_follows.__fp_text").alias("__fp_next_text"), F.col("__fp_follows.__fp").alias("__fp_next"))
    )


def edited(text: Column, after: Column) -> Column:
    """The last third gives way to the first code points of the next text, as many or all."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.left(text, F.length(text) - third), F.left(after, third))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    rows = rows.withColumn("__fp_edited", edited(F.col("__fp_text"), F.col("__fp_next_text")))
    rows = rows.withColumn("__fp_e", fingerprint(F.col("__fp_edited")))
    return rows.select(
        "doc_id",
        F.length("__fp_text").cast("long").alias("n_chars"),
        F.sha2("__fp_edited", 256).alias("edited_sha256"),
        text_form(F.col("__fp")).alias("fingerprint"),
        text_form(F.col("__fp_e")).alias("edited_fingerprint"),
        likeness(F.col("__fp"), F.col("__fp_e")).alias("near_edited"),
        likeness(F.col("__fp"), F.col("__fp_next")).alias("near_next"),
    )
