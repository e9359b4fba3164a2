"""Best-fit packing of documents into sequences of a fixed length, by sum of squares.

Documents become token ids and an end id. Longer ones are cut into full pieces from their
end, so only the first piece may be shorter. Full pieces are sequences already. The other
pieces are dealt into groups of about ``GROUP`` by a hash of their row number; a group packs
on its own with the sum-of-squares rule: a piece goes to the open sequence, or a new one,
after which the sum over residual gaps of (open sequences with that gap) squared is
smallest. Pieces over half a sequence come first, largest first; the others follow in
hashed order, which keeps the gap counts level. Where that order leaves more sequences
than all pieces by size would, the group keeps the latter.

Only piece numbers travel between tasks, never ids or texts. A group's size doesn't depend
on the input's size; its number of groups does. Every row has its own number, so repeated
ids or texts can't fill one group.

Tokens come from the byte-level BPE ranks that equal the JSON vocabulary; a text that holds
a special token's string goes through the JSON tokenizer itself, which reads it as that token.

Defined cases: null texts count as empty (one piece, the end id); ids may be null or
repeated, each row is packed; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import materialise, table

LENGTH, END_ID, GROUP = 1024, 2, 100_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of a text exactly as the tokenizers library gives them without special tokens added."""

    def __init__(self, path: str):
        import public_tokenizers as P
        import tiktoken
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.special = [t.content for t in self.plain.get_added_tokens_decoder().values()]
        ranks_path = os.path.splitext(path)[0] + ".tiktoken"
        self.fast = None
        if os.path.exists(ranks_path):
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, "<u4")
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of each piece; the first takes what is left over."""
    first = n % length or length
    return [(0, min(first, n)), *((s, length) for s in range(first, n, length))] if n else []


def tokenised(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(encode(text), np.uint32(END_ID)).astype("<u4")
                own = None if pd.isna(doc_id) else int(doc_id)
                rows += [(own, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cuts(len(ids), length))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64", "piece": "int32"})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInPandas(pieces, PIECES)


def sum_of_squares(sizes: np.ndarray, order: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each size, placed in that order, and the number of sequences."""
    count = np.zeros(length + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(length + 1)]
    sequence, offset, made = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
    never = np.int64(1) << 60
    for i in order.tolist():
        s = int(sizes[i])
        with_gap, after = count[s:], count[: length - s + 1]
        change = 2 * (after - with_gap) + 2
        change[0] = 1 - 2 * with_gap[0]  # a filled sequence leaves the sum
        change[with_gap == 0] = never
        j = int(change.argmin())
        opening = 2 * int(count[length - s]) + 1 if s < length else 0
        if change[j] < never and change[j] <= opening:
            gap = s + j
            at = stacks[gap].pop()
            count[gap] -= 1
        else:
            gap, at, made = length, made, made + 1
        sequence[i], offset[i] = at, length - gap
        if gap > s:
            count[gap - s] += 1
            stacks[gap - s].append(at)
    return sequence, offset, made


def pack_sizes(sizes: np.ndarray, mixed: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, int]:
    """Packs with large pieces first and the rest in the order of mixed, or all by size if that makes fewer sequences."""
    by_size = np.lexsort((mixed, -sizes))
    large = sizes[by_size] > length // 2
    shuffled = np.argsort(mixed, kind="stable")
    first = sum_of_squares(sizes, np.concatenate([by_size[large], shuffled[sizes[shuffled] <= length // 2]]), length)
    second = sum_of_squares(sizes, by_size, length)
    return first if first[2] <= second[2] else second


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """One row for each piece of each document with its sequence and its place there."""
    pieces = materialise(tokenised(docs, path, id_col, text_col, length).withColumn("row", F.monotonically_increasing_id()), "pieces")
    short = pieces.filter(F.col("length") < length)
    groups = max(1, -(-short.count() // group))

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        sequence, offset, _ = pack_sizes(rows["length"].to_numpy(), rows["mixed"].to_numpy(), length)
        rows["sequence_id"], rows["offset"] = sequence + (int(key[0]) << 32), offset
        return rows[[*names, "sequence_id", "offset"]]

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    dealt = short.withColumn("mixed", F.xxhash64("row")).withColumn("g", F.pmod("mixed", F.lit(groups)))
    out = dealt.groupBy("g").applyInPandas(packed, f"{PIECES}, sequence_id long, offset long")
    full = pieces.filter(F.col("length") == length).select(*names, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return out.unionByName(full)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary())
