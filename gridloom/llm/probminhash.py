"""Near-duplicates by ProbMinHash, banding and exact verification.

A text is its five-word shingles (lower case, runs of letters, digits and non-ASCII bytes;
a text of fewer words is one shingle). Two different texts are linked where the Jaccard
similarity of their shingle sets is at least ``SIMILARITY``; classes are the connected parts.

1. One pass over whole texts gives each its word sequence's 128-bit hash (its node: copies
   share one), its ``BANDS`` band keys and a short sketch. Signatures are ProbMinHash: each shingle
   is a Poisson process of arrivals at random registers; a shingle leaves as soon as its next
   arrival comes after its text's slowest register. Every shingle has weight 1, however often its
   text repeats it, so registers agree with the very similarity that links are defined by. A pair
   at similarity s shares no band with probability (1 - s**4)**24: 3.2e-6 at 0.8, less above.
2. Each node is tested against one candidate, the least leader of its buckets; confirmed
   links give first classes. A bucket of one class needs no more tests, so groups of near
   copies end here with one test a member.
3. Buckets that hold several classes are searched whole. Of two nodes the pair is tested,
   unless it was. In larger ones members of different classes whose sketches agree in
   ``SKETCH_LEAST`` of the registers are verified by their sets, until they join; registers agree
   independently with probability s, so a pair at 0.8 falls short of that with probability 6e-18
   at most. Large buckets are searched block against block, at most ``BLOCK`` nodes of each side
   in one task, so memory is bounded and no pair is left out.
4. Links of both steps give the classes, by alternating large and small stars.

The result tells the classes, not all links inside them: a class of n texts has up to n * n / 2.
``links`` counts the links of a text that were confirmed on the way, at least one for each text
of a class of several; ``links_of`` returns them.

Skew: copies combine on the map side; leaders, sets and classes go back to their rows over salts
that follow the groups' sizes; nothing is collected. Every step that another reads twice is a
table in the shared folder, deleted after its last reader.

Defined cases: null texts count as empty; texts without words are alike only where they are
identical; of a class the smallest id stays, null ids after all others, and of rows that
repeat id and text exactly one; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import discard, give_back, materialise, table
from gridloom.operators.graph import parts

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
SKETCH_LEAST, BLOCK, SALTS, COPIES, AT_ONCE = 0.4, 256, 32, 2_000, 1 << 21
U = np.uint64
ODD, GOLDEN = U(0x9E3779B97F4A7C15 | 1), U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: U, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[:1] = 1
    return np.multiply.accumulate(out)


INVERSE = U(pow(int(ODD), -1, 1 << 64))
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts, and where each text's words begin (one more at the end)."""
    blobs = [t.lower().encode() for t in texts]
    data = np.frombuffer(b" ".join(blobs) + b" ", np.uint8)
    starts_of = np.cumsum([0, *(len(b) + 1 for b in blobs)])
    inside = WORD_BYTE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
    begins, ends = edge[::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, U), np.cumsum((data.astype(U) + U(1)) * powers(ODD, len(data)), dtype=U)])
    hashes = mix((sums[ends] - sums[begins]) * powers(INVERSE, len(data) + 1)[begins] + (ends - begins).astype(U))
    return hashes, np.searchsorted(begins, starts_of)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Distinct shingles of all texts: text number, hash and count, by text and hash; and each text's node."""
    words, at = word_hashes(texts)
    lengths = np.diff(at)
    place = np.arange(len(words)) - np.repeat(at[:-1], lengths)
    nodes = []
    for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        content = words[a:b].tobytes() if b > a else b"\0" + texts[k].encode()
        nodes.append(hashlib.blake2b(content, digest_size=16).digest())
    owner = np.repeat(np.arange(len(texts)), lengths)
    size = np.minimum(np.repeat(lengths, lengths), WORDS)
    first = place + size <= np.repeat(lengths, lengths)
    h = np.zeros(len(words), U)
    for j in range(WORDS):
        part = np.zeros(len(words), U)
        part[: len(words) - j] = words[j:]
        h += np.where(size > j, part * powers(U(0xD6E8FEB86659FD93), WORDS + 1)[j + 1], U(0))
    owner, h = owner[first], mix(h[first])
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    places = np.flatnonzero(new)
    return owner[places], h[places], np.diff(np.append(places, len(h))), nodes


def signatures(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The shingle that reaches each register first: n rows of REGISTERS hashes."""
    first = np.full(n * REGISTERS, np.inf)
    taken = np.zeros(n * REGISTERS, U)
    who, h, rate, t = owner.astype(np.int64), hashes, 1 + np.log(counts), np.zeros(len(hashes))
    k = 0
    while len(who):
        draw = mix(h + np.full(1, k + 1, U) * GOLDEN)
        t = t - np.log(((draw >> U(11)).astype(np.float64) + 0.5) / (1 << 53)) / rate
        key = who * REGISTERS + (mix(draw ^ ODD) % U(REGISTERS)).astype(np.int64)
        better = t < first[key]
        bk, bt, bh = key[better], t[better], h[better]
        np.minimum.at(first, bk, bt)
        won = first[bk] == bt
        taken[bk[won]] = bh[won]
        slowest = first.reshape(n, REGISTERS).max(axis=1)
        go = t < slowest[who]
        who, h, rate, t = who[go], h[go], rate[go], t[go]
        k += 1
    return taken.reshape(n, REGISTERS)


def band_keys(taken: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(taken), BANDS), U)
    for j in range(ROWS):
        keys = mix(keys * ODD + taken[:, j::ROWS])
    return mix(keys + np.arange(1, BANDS + 1, dtype=U) * GOLDEN).astype(np.int64)


def in_runs(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about AT_ONCE characters; a longer text is a run of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > AT_ONCE:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, texts[start:]


def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start, run in in_runs(batch["text"].tolist()):
            owner, h, counts, nodes = shingles(run)
            taken = signatures(owner, h, np.ones_like(counts), len(run))
            some = np.bincount(owner, minlength=len(run)) > 0
            keys = band_keys(taken)
            part = batch.iloc[start : start + len(run)]
            yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "th": part["th"].to_numpy(), "node": nodes, "bands": [k if s else k[:0] for k, s in zip(keys, some, strict=True)]})


def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Node, sorted shingle set and sketch of the texts whose node is wanted."""
    for batch in batches:
        for start, run in in_runs(batch["text"].tolist()):
            owner, h, counts, nodes = shingles(run)
            taken = signatures(owner, h, np.ones_like(counts), len(run))
            at = np.searchsorted(owner, np.arange(len(run) + 1))
            wanted = batch["node"].iloc[start : start + len(run)].tolist()
            rows = [(nodes[k], h[at[k] : at[k + 1]].tobytes(), (taken[k] & U(0xFFFF)).astype("<u2").tobytes()) for k in range(len(run)) if nodes[k] == bytes(wanted[k])]
            yield pd.DataFrame(rows, columns=["node", "set", "sketch"])


def similarity(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, U), np.frombuffer(b, U)
    if min(len(x), len(y)) < SIMILARITY * max(len(x), len(y)):
        return 0.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def _salt(column: str) -> F.Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int")


def components(links: DataFrame) -> DataFrame:
    """(node, class) for every end of a link (a, b); the class is its least node."""
    return parts(links).withColumnRenamed("part", "class")


def first_pairs(members: DataFrame) -> DataFrame:
    """Each node with the least leader of its buckets. members: (key, node, lead)."""
    return members.filter("node != lead").groupBy(F.col("node").alias("a")).agg(F.min("lead").alias("b"))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough. Of a set that many pairs have as their b, at most COPIES copies in all are dealt to them."""
    leads = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")).join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    ends = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
    ends = give_back(ends, materialise(leads, "leads"), ["b"], "n", "a", "inner", COPIES)

    @F.pandas_udf("double")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([similarity(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    return ends.withColumn("s", alike("sa", "sb")).filter(F.col("s") >= SIMILARITY).select("a", "b")


def search(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between members of different classes of one bucket, or of two of its blocks (side 0 and 1; 2: both)."""
    rows = rows.drop_duplicates("node").sort_values("node").reset_index(drop=True)
    sketch = np.stack([np.frombuffer(x, "<u2") for x in rows["sketch"]])
    nodes, sets, side = rows["node"].tolist(), rows["set"].tolist(), rows["side"].to_numpy()
    label = pd.factorize(rows["class"])[0]
    out = []
    for lo in range(0, len(rows), 32):
        mine = slice(lo, lo + 32)
        test = (np.arange(len(rows))[mine, None] < np.arange(len(rows))) & (label[mine, None] != label) & ((side[mine, None] == 2) | (side[mine, None] != side))
        if not test.any():
            continue
        test &= (sketch[mine, None, :] == sketch[None, :, :]).mean(axis=2) >= SKETCH_LEAST
        for i, j in np.argwhere(test) + [lo, 0]:
            if label[i] != label[j] and similarity(sets[i], sets[j]) >= SIMILARITY:
                out.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    return pd.DataFrame(out, columns=["a", "b"])


def further_links(members: DataFrame, classes: DataFrame, sets: DataFrame, tested: DataFrame) -> DataFrame:
    """Links that buckets of several classes still hide.

    A bucket of two nodes is one pair, and most of these were tested; the rest are confirmed by joins, once each.
    In larger buckets the largest class's blocks are searched against the others', and these among themselves.
    """
    named = members.join(classes, "node", "left").select("key", "node", F.coalesce("class", "node").alias("class"))
    by_class = named.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"))
    mixed = by_class.groupBy("key").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("all"), F.max(F.struct("n", "class")).alias("top")).filter("classes > 1")
    mixed = materialise(mixed, "mixed")
    two = named.join(mixed.filter(F.col("all") == 2).select("key"), "key", "left_semi").groupBy("key").agg(F.max("node").alias("a"), F.min("node").alias("b")).select("a", "b").distinct()
    plain = confirmed(materialise(two.join(tested, ["a", "b"], "left_anti"), "pairs"), sets)
    n_top, n_rest = F.ceil(F.col("top.n") / BLOCK).cast("int"), F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int")
    larger = mixed.filter(F.col("all") > 2).select("key", "all", F.col("top.class").alias("top_class"), n_top.alias("nt"), n_rest.alias("nr"))
    rows = give_back(named, larger, ["key"], "all", "node", "inner").drop("__gb_salt", "all")
    is_top, h = F.col("class") == F.col("top_class"), F.xxhash64("node")
    own_top, own_rest = F.pmod(h, F.col("nt")).cast("int"), F.pmod(h, F.col("nr")).cast("int")

    def seat(kind: str, i: F.Column, j: F.Column, side: F.Column) -> F.Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))

    across_top = F.transform(F.sequence(F.lit(0), F.col("nr") - 1), lambda j: seat("t", own_top, j, F.lit(0)))
    across_rest = F.transform(F.sequence(F.lit(0), F.col("nt") - 1), lambda i: seat("t", i, own_rest, F.lit(1)))
    among = F.transform(F.sequence(F.lit(0), F.col("nr") - 1), lambda k: seat("r", F.least(own_rest, k), F.greatest(own_rest, k), F.when(own_rest == k, 2).otherwise(F.when(own_rest < k, 0).otherwise(1))))
    one = F.array(seat("a", F.lit(0), F.lit(0), F.lit(2)))
    seats = F.when(F.col("all_small"), one).when(is_top, across_top).otherwise(F.concat(across_rest, among))
    dealt = rows.withColumn("all_small", (F.col("nt") == 1) & (F.col("nr") == 1)).withColumn("seat", F.explode(seats)).select("key", "seat.*", "node", "class")
    found = dealt.join(sets, "node").groupBy("key", "kind", "i", "j").applyInPandas(lambda rows: search(rows), "a binary, b binary")
    return plain.unionByName(found)


def links_of(plain: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Confirmed pairs (a, b) of nodes, each once, that connect all that is alike. plain: id, text, th; rows: signed; nodes: with their least row."""
    # Buckets with several nodes, their leaders, and who belongs to them.
    seats = rows.select("node", F.explode("bands").alias("key"))
    leaders = (
        seats.groupBy("key", _salt("node").alias("salt")).agg(F.min("node").alias("lead"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n"))
        .groupBy("key").agg(F.min("lead").alias("lead"), F.max("last").alias("last"), F.sum("n").alias("n")).filter("lead != last").drop("last")
    )
    leaders = materialise(leaders, "leaders")
    members = materialise(give_back(seats, leaders, ["key"], "n", "node", "inner").select("key", "node", "lead").distinct(), "members")

    # Sets of the nodes in such buckets, from one text each.
    wanted = members.select("node").distinct().join(nodes, "node").select("node", F.col("least.doc_id").alias("want_id"), F.col("least.th").alias("want_th"))
    sources = plain.join(wanted, (F.col("th") == F.col("want_th")) & F.col("doc_id").eqNullSafe(F.col("want_id"))).select("node", "text")
    sets = materialise(sources.mapInPandas(sets_of, "node binary, set binary, sketch binary").dropDuplicates(["node"]), "sets")

    pairs = materialise(first_pairs(members), "pairs")
    links = materialise(confirmed(pairs, sets), "links")
    found = materialise(components(links), "classes")
    out = materialise(links.unionByName(further_links(members, found, sets, pairs)).distinct(), "links")
    discard(leaders, members, sets, pairs, links, found)
    return out


def classes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row (doc_id, th, class_id, class_size, class_texts, links, kept) for each document; th is a hash of its text."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    # A nullable long must not pass through a double.
    texts = plain.withColumn("doc_id", F.col("doc_id").cast("string"))
    rows = materialise(texts.mapInPandas(signed, "doc_id string, th long, node binary, bands array<long>").withColumn("doc_id", F.col("doc_id").cast("long")), "signed")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("th").alias("th"))
    nodes = materialise(rows.groupBy("node").agg(F.min(rank).alias("least"), F.count(F.lit(1)).alias("n")), "nodes")
    links = links_of(plain, rows, nodes)
    classes = components(links)
    counts = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))

    joined = materialise(nodes.join(classes, "node", "left").join(counts, "node", "left").withColumn("class", F.coalesce("class", "node")), "joined")
    whole = materialise(joined.groupBy("class").agg(F.min("least").alias("rep"), F.sum("n").alias("class_size"), F.count(F.lit(1)).alias("class_texts")), "classes")
    back = give_back(joined.select("node", "class", "n", "links"), whole, ["class"], "class_texts", "node", "inner").drop("__gb_salt", "class")
    out = give_back(rows.drop("bands"), materialise(back, "back"), ["node"], "n", "doc_id", "inner")
    discard(nodes, joined, whole)
    same = Window.partitionBy("node", "__gb_salt", "doc_id", "th").orderBy(F.lit(0))
    kept = F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("th") == F.col("rep.th")) & (F.row_number().over(same) == 1)
    return out.select("doc_id", "th", F.col("rep.doc_id").alias("class_id"), "class_size", "class_texts", F.coalesce("links", F.lit(0)).alias("links"), kept.alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay: one of each class, with their columns and no others."""
    kept = classes_of(docs, id_col, text_col).filter("kept").select(F.col("doc_id").alias("__nd_id"), F.col("th").alias("__nd_th"))
    mine = docs.withColumn("__nd_h", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    same = Window.partitionBy(id_col, "__nd_h").orderBy(*others, F.lit(0))
    rows = mine.join(kept, F.col(id_col).eqNullSafe(F.col("__nd_id")) & (F.col("__nd_h") == F.col("__nd_th")), "left_semi")
    return rows.withColumn("__nd_nth", F.row_number().over(same)).filter("__nd_nth = 1").select(*docs.columns)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes_of(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "class_texts", "links", "kept")
