"""What the corpus operators share: table access, the shared folder, and row-local column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.scratch import discard, materialise
from gridloom.sources.scratch import path as scratch_path

__all__ = ["HOT", "SPAN", "discard", "give_back", "let", "materialise", "regex_spans", "running", "running_total", "scratch_path", "table", "whole_text"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluates value once per row and hands it to body."""
    return F.element_at(F.transform(F.array(value), body), 1)


HOT = 20_000


def give_back(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, deal_by: str, how: str = "left", hot: int = HOT) -> DataFrame:
    """rows joined to groups, a written table of one row for each key with its number of rows in ``size``.

    Groups of more than 1 / hot of all rows are fewer than hot, so a number for each of their keys'
    hashes (16 bytes, and nothing else) is broadcast; rows of such a hash are dealt over that many
    copies of their group, as many as the group holds such shares.
    So no task gets more than a share of the rows of one key, at any size of the table. __gb_salt,
    which follows from deal_by, stays: a window by the keys and it needs no further shuffle.
    """
    share = (groups.agg(F.sum(size)).first()[0] or 0) // hot + 1
    copies = F.floor((F.col(size) - 1) / share).cast("int")
    h = F.xxhash64(*keys)
    large = groups.filter(F.col(size) > share).groupBy(h.alias("__gb_key")).agg(F.max(copies + 1).alias("__gb_copies"))

    def counted(side: DataFrame) -> DataFrame:
        return side.withColumn("__gb_key", h).join(F.broadcast(large), "__gb_key", "left").withColumn("__gb_copies", F.coalesce("__gb_copies", F.lit(1)))

    dealt = counted(rows).withColumn("__gb_salt", F.pmod(F.xxhash64(deal_by), "__gb_copies").cast("int")).drop("__gb_key", "__gb_copies")
    spread = counted(groups).withColumn("__gb_salt", F.explode(F.sequence(F.lit(0), F.col("__gb_copies") - 1))).drop("__gb_key", "__gb_copies")
    return dealt.join(spread, [*keys, "__gb_salt"], how)


def whole_text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def running(values: Column, step: Callable[[Column, Column], Column], start: Column, block: int = 64) -> Column:
    """Inclusive running results of an associative step over an array; start is its neutral element.

    Results run inside blocks and then over the blocks' own, so a text with n matches
    costs n * block steps and not n * n.
    """
    n = F.size(values)

    def within(b: Column, before: Column) -> Column:
        return F.transform(b, lambda v, i: F.aggregate(F.slice(b, F.lit(1), i + 1), before, step))

    def in_blocks(x: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")), lambda k: F.slice(x, k * block + 1, F.lit(block)))
        return let(blocks, from_blocks)

    def from_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, start, step))
        before = F.aggregate(totals, F.array(start), lambda a, t: F.concat(a, F.array(step(F.element_at(a, -1), t))))
        return F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), within))

    return F.when(n == 0, values).when(n <= block, within(values, start)).otherwise(let(values, in_blocks))


def running_total(lengths: Column, block: int = 64) -> Column:
    return running(lengths, lambda a, x: a + x, F.lit(0), block)


SPAN = "array<struct<start:int,end:int,match:string,before:string,after:string>>"


def regex_spans(text: Column, pattern: str, hint: Column | None = None) -> Column:
    """Every leftmost non-overlapping match with code point offsets and the text on both sides of it.

    Splitting a text at a pattern and extracting the pattern walk the same matches, so
    offsets are running sums of the lengths of both. hint skips texts that can't match.
    """
    nothing = F.array().cast(SPAN)

    def rows(p: Column) -> Column:
        gaps, found = p["gaps"], p["found"]
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), F.concat(F.array(F.lit("")), F.slice(found, F.lit(1), F.size(found) - 1)), lambda g, m: F.length(g) + F.length(m))
        return let(running_total(steps), lambda starts: F.transform(found, lambda m, i: F.struct(
            F.element_at(starts, i + 1).alias("start"), (F.element_at(starts, i + 1) + F.length(m)).alias("end"), m.alias("match"),
            F.right(F.element_at(gaps, i + 1), F.lit(48)).alias("before"), F.left(F.element_at(gaps, i + 2), F.lit(48)).alias("after"))))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pair = F.struct(F.split(text, pattern, -1).alias("gaps"), found.alias("found"))
    got = let(pair, lambda p: F.when(F.size(p["found"]) > 0, rows(p)).otherwise(nothing))
    return got if hint is None else F.when(hint, got).otherwise(nothing)
