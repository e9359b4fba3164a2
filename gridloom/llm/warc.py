"""WARC archives with a two-level capture index.

Writing: every task writes one archive of separately compressed records to the shared
folder and returns a capture row for each. Of records with equal payloads of at least
``LEAST`` bytes the one with the smallest id is the response; others are revisits that
name it by the standard headers (WARC-Refers-To, its target and date) and store no payload.
A record's id is a version 8 UUID whose first 64 free bits are the page's id, so a revisit's
WARC-Refers-To tells the page it refers to; the others hash url, digest and repetition.

Index: captures are sorted by reversed-host key (``com,example,www)/path``) and id, by
ranges over all tasks. Each range becomes one shard file of compressed blocks of ``BLOCK``
lines, with a sparse directory beside it: the first key, offset and length of each block.
The driver keeps one row for each shard: its number is the number of partitions.

Reading: a lookup finds its shard and its block by binary search, reads and opens that
block alone, finds its line by binary search, and reads the record's byte range. Lookups
come sorted, so a task opens each block and directory once.

Skew: equal payloads combine on the map side and over salts; the way back to the pages is
dealt over as many salts as a payload's share of the pages asks for; a host with a third of
all pages is spread by id within its range.

Stores: archives and index go to any store that Arrow opens under Spark's names of it (file,
hdfs, s3a, gs, abfss, dbfs by its mount); others are refused before anything runs.

Recovery: a file's name is its attempt's own and rows that name it count only when the task
succeeded, so a lost executor leaves at most unused files. Captures are a written table.

Defined cases: null html is the empty payload; a null url has the empty key and no target;
rows that repeat page_id and html give one response and revisits; null ids sort first and are
never referred to unless no other row has the payload; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import discard, give_back, materialise, scratch_path, table, whole_text
from gridloom.sources.files import arrow_uri, file_system

LEAST, BLOCK, SALTS, DATE = 100, 512, 32, "2024-01-01T00:00:00Z"
NO_ID = -(1 << 63)
CAPTURE = "surt string, page_id long, file string, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


# Columns


def surt(url: Column) -> Column:
    """Reversed host, then path and query: pages of a domain stand together."""
    text = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1))
    rest = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.when(text == "", "").otherwise(F.regexp_replace(key, r"\s", "+"))


def planned(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Every page with its digest and whether its record is a response or a revisit."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), whole_text(F.col(html_col)).alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("html", 256))).withColumn("bytes", F.octet_length("html").cast("long"))
    first = F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.coalesce("url", F.lit("")).alias("order"), "url")
    firsts = materialise(
        rows.groupBy("digest", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).alias("salt")).agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
        .groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("n")), "payloads")
    rows = give_back(rows, firsts, ["digest"], "n", "page_id", "inner")
    same = Window.partitionBy("digest", "__gb_salt", "page_id").orderBy(F.coalesce("url", F.lit("")), "url")
    rows = rows.withColumn("nth", F.row_number().over(same))
    own = (F.col("bytes") < LEAST) | (F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("nth") == 1))
    return rows.select(
        "page_id", "url", surt(F.col("url")).alias("surt"), "bytes", F.lower(F.hex("digest")).alias("digest"), "nth", own.alias("response"),
        F.when(~own, F.col("first.page_id")).alias("refers_to"), F.when(~own, F.col("first.url")).alias("refers_url"), F.when(own, F.col("html")).alias("html"))


# Records


def record_id(page_id: int | None, url: str | None, digest: str, nth: int) -> str:
    """A version 8 UUID: the page's id in 64 bits, and 58 bits of a hash."""
    rest = int.from_bytes(hashlib.sha256(f"{url}|{digest}|{nth}".encode()).digest()[:8]) >> 6
    bits = ((NO_ID if page_id is None else page_id) % (1 << 64)) << 58 | rest
    return f"<urn:uuid:{uuid.UUID(int=(bits >> 74) << 80 | 8 << 76 | (bits >> 62 & 0xFFF) << 64 | 2 << 62 | bits & (1 << 62) - 1)}>"


def page_of(record_id: str) -> int | None:
    """The page's id in a record's id."""
    n = uuid.UUID(record_id.removeprefix("<urn:uuid:").removesuffix(">")).int
    bits = (n >> 80) << 74 | (n >> 64 & 0xFFF) << 62 | n & (1 << 62) - 1
    page = bits >> 58
    page -= page >> 63 << 64
    return None if page == NO_ID else page


def target(url: str) -> str:
    """A url as one line of a header."""
    return json.dumps(url)[1:-1]


def record(page_id: int | None, url: str | None, digest: str, size: int, refers: tuple[int | None, str | None] | None, payload: bytes | None, nth: int = 1) -> bytes:
    """One compressed record. A revisit keeps the response's header block, so the payload's size stays known; refers is its response's page and url."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, url, digest, nth)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + target(url))
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response"]
    if payload is None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(*refers, digest, 1)}", f"WARC-Refers-To-Date: {DATE}"]
        if refers[1] is not None:
            head.append("WARC-Refers-To-Target-URI: " + target(refers[1]))
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def headers(block: bytes) -> tuple[str, dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    return lines[0], dict(line.split(": ", 1) for line in lines[1:]), body


def parse(blob: bytes) -> tuple:
    """A row of RECORD. A response's digest is taken from its payload and must be what its header says."""
    version, head, body = headers(zlib.decompress(blob, 31))
    if version != "WARC/1.1":
        raise ValueError(f"not a record: {version[:20]!r}")
    block = body[: int(head["Content-Length"])]
    _, http, payload = headers(block)
    digest, size = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(http["Content-Length"])
    if head["WARC-Type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"payload of record {head['WARC-Record-ID']} is damaged")
    url = head.get("WARC-Target-URI")
    refers = head.get("WARC-Refers-To")
    return page_of(head["WARC-Record-ID"]), None if url is None else json.loads(f'"{url}"'), size, digest, head["WARC-Type"], None if refers is None else page_of(refers)


# Files


def create(folder: str, kind: str):
    """A new file that only this attempt of this task has, and its name."""
    system, root = file_system(folder)
    context = TaskContext.get()
    name = f"{kind}-{context.partitionId():06d}-{context.attemptNumber()}-{uuid.uuid4().hex[:8]}"
    system.create_dir(root, recursive=True)
    return name, system.open_output_stream(f"{root}/{name}", compression=None)


@lru_cache(32)
def opened(folder: str, name: str):
    system, root = file_system(folder)
    return system.open_input_file(f"{root}/{name}")


def read_range(folder: str, name: str, offset: int, length: int) -> bytes:
    return opened(folder, name).read_at(length, offset)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives and returns the captures."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = out = None
        at = 0
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                if out is None:
                    name, out = create(folder, "archive")
                page = None if pd.isna(r.page_id) else int(r.page_id)
                refers = (None if pd.isna(r.refers_to) else int(r.refers_to), r.refers_url)
                blob = record(page, r.url, r.digest, int(r.bytes), refers, r.html.encode() if r.response else None, int(r.nth))
                out.write(blob)
                rows.append((r.surt, NO_ID if page is None else page, name, at, len(blob)))
                at += len(blob)
            if rows:
                yield pd.DataFrame(rows, columns=["surt", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    arrow_uri(folder)  # a store that the tasks can't write to is refused here
    rows = planned(pages, id_col, url_col, html_col)
    # Ids go as decimals' text would: a nullable long must not pass through a double.
    typed = rows.withColumn("page_id", F.col("page_id").cast("string")).withColumn("refers_to", F.col("refers_to").cast("string"))
    return materialise(typed.mapInPandas(write, CAPTURE), "captures")


# Index


def write_index(captures: DataFrame, folder: str, block: int = BLOCK) -> list[tuple]:
    """Writes shards and directories; returns (first key, first id, shard, directory) of each shard in order."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = out = first = None
        at, lines, places = 0, [], []

        def flush() -> None:
            nonlocal at, lines
            blob = zlib.compress("\n".join(f"{s}\t{i}\t{f}\t{o}\t{n}" for s, i, f, o, n in lines).encode(), 6)
            places.append((lines[0][0], lines[0][1], at, len(blob)))
            out.write(blob)
            at, lines = at + len(blob), []

        for batch in batches:
            for row in batch.itertuples(index=False, name=None):
                if out is None:
                    name, out = create(folder, "shard")
                    first = row[:2]
                lines.append(row)
                if len(lines) == block:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            directory, beside = create(folder, "directory")
            beside.write(json.dumps(places).encode())
            beside.close()
            yield pd.DataFrame([(*first, name, directory)], columns=["surt", "page_id", "shard", "directory"])

    shards = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(shards, "surt", "page_id").sortWithinPartitions("surt", "page_id")
    return sorted(tuple(r) for r in ordered.mapInPandas(write, "surt string, page_id long, shard string, directory string").collect())


@lru_cache(8)
def directory_of(folder: str, name: str) -> list[tuple]:
    source = opened(folder, name)
    return [tuple(x) for x in json.loads(source.read_at(source.size(), 0))]


@lru_cache(8)
def block_of(folder: str, shard: str, offset: int, length: int) -> list[tuple]:
    lines = zlib.decompress(read_range(folder, shard, offset, length)).decode().split("\n")
    return [(s, int(i), f, int(o), int(n)) for s, i, f, o, n in (x.split("\t") for x in lines)]


def find(folder: str, shards: list[tuple], key: tuple[str, int]) -> list[tuple[str, int, int]]:
    """(file, offset, length) of every capture of the key: shard, block and line by binary search."""
    at = bisect_right(shards, key, key=lambda s: s[:2]) - 1
    if at < 0:
        return []
    _, _, shard, directory = shards[at]
    places = directory_of(folder, directory)
    out = []
    for _, _, offset, length in places[max(0, bisect_left(places, key, key=lambda p: p[:2]) - 1) : bisect_right(places, key, key=lambda p: p[:2])]:
        lines = block_of(folder, shard, offset, length)
        out += [x[2:] for x in lines[bisect_left(lines, key, key=lambda x: x[:2]) : bisect_right(lines, key, key=lambda x: x[:2])]]
    return out


def lookup(keys: DataFrame, folder: str, shards: list[tuple]) -> DataFrame:
    """The records of distinct keys (surt, page_id), read back from the archives."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places = [p for key in batch.itertuples(index=False, name=None) for p in find(folder, shards, key)]
            rows = [parse(read_range(folder, *p)) for p in sorted(places)]
            yield pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]).astype({"page_id": "Int64", "refers_to": "Int64"})

    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.select("surt", "page_id").repartitionByRange(n, "surt", "page_id").sortWithinPartitions("surt", "page_id")
    return ordered.mapInPandas(read, RECORD)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), scratch_path(spark, "warc")
    captures = write_archives(pages.select("page_id", "url", "html"), folder)
    shards = write_index(captures, folder)
    discard(captures)
    keys = pages.select(surt(F.col("url")).alias("surt"), F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("page_id")).distinct()
    return lookup(keys, folder, shards).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


ORACLE = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, url, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to, url
FROM f
"""
