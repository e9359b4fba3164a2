"""OpenStreetMap extracts (PBF) as a source: one partition for each run of blobs.

Only blob headers are read to plan; tasks decode their blobs. Kinds and a box are options of the
source: groups of other kinds aren't decoded, and nodes elsewhere aren't returned. (Filters pushed by
the engine stay with a frame's source for its other readers, so they aren't used.) Nodes, ways and relations come as
one relation; ``lines`` and ``areas`` join way points to nodes in Spark, so no node index has
to fit in memory.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "kind string, id long, tags map<string,string>, lon double, lat double, refs array<long>"


def varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[i]
        value |= (byte & 127) << shift
        shift, i = shift + 7, i + 1
        if byte < 128:
            return value, i


def message(data: bytes) -> Iterator[tuple[int, object]]:
    i = 0
    while i < len(data):
        key, i = varint(data, i)
        if key & 7 == 0:
            value, i = varint(data, i)
        elif key & 7 == 2:
            n, i = varint(data, i)
            value, i = data[i : i + n], i + n
        else:
            n = 8 if key & 7 == 1 else 4
            value, i = data[i : i + n], i + n
        yield key >> 3, value


def packed(data: bytes, signed: bool = False) -> list[int]:
    out, i = [], 0
    while i < len(data):
        v, i = varint(data, i)
        out.append((v >> 1) ^ -(v & 1) if signed else v)
    return out


def running(values: list[int]) -> list[int]:
    total, out = 0, []
    for v in values:
        total += v
        out.append(total)
    return out


def blobs(path: str) -> list[tuple[int, int, str]]:
    """(offset, length, kind) of each blob."""
    from gridloom.sources.tiff import _open

    out, at = [], 0
    with _open(path) as f:
        size = f.size()
        while at < size:
            n = struct.unpack(">I", f.read_at(4, at))[0]
            head = dict(message(f.read_at(n, at + 4)))
            out.append((at + 4 + n, head[3], head[1].decode()))
            at += 4 + n + head[3]
    return out


def inflate(blob: bytes) -> bytes:
    parts = dict(message(blob))
    if 1 in parts:
        return parts[1]
    if 3 in parts:
        return zlib.decompress(parts[3])
    raise ValueError("only plain and zlib blobs are supported")


KINDS = {1: "node", 2: "node", 3: "way", 4: "relation"}


def entities(block: bytes, kinds: frozenset[str] = frozenset(KINDS.values())) -> Iterator[tuple]:
    fields = list(message(block))
    strings = [v.decode("utf-8", "replace") for k, v in message(next(v for k, v in fields if k == 1)) if k == 1]
    scalars = {k: v for k, v in fields if k in (17, 19, 20)}
    grain, lat0, lon0 = scalars.get(17, 100), scalars.get(19, 0), scalars.get(20, 0)
    place = lambda v, base: (base + grain * v) * 1e-9
    unzig = lambda v: (v >> 1) ^ -(v & 1)
    for _, group in ((k, v) for k, v in fields if k == 2):
        for kind, data in message(group):
            if KINDS.get(kind) not in kinds:
                continue
            parts = {}
            for k, v in message(data):
                parts[k] = v
            if kind == 1:
                tags = dict(zip((strings[i] for i in packed(parts.get(2, b""))), (strings[i] for i in packed(parts.get(3, b""))), strict=True))
                yield "node", unzig(parts[1]), tags, place(unzig(parts[9]), lon0), place(unzig(parts[8]), lat0), None
            elif kind == 2:
                ids, lats, lons = (running(packed(parts[k], True)) for k in (1, 8, 9))
                pairs, at = packed(parts.get(10, b"")), 0
                for i, (n, la, lo) in enumerate(zip(ids, lats, lons, strict=True)):
                    tags = {}
                    while at < len(pairs) and pairs[at]:
                        tags[strings[pairs[at]]] = strings[pairs[at + 1]]
                        at += 2
                    at += 1
                    yield "node", n, tags, place(lo, lon0), place(la, lat0), None
            elif kind in (3, 4):
                tags = dict(zip((strings[i] for i in packed(parts.get(2, b""))), (strings[i] for i in packed(parts.get(3, b""))), strict=True))
                refs = running(packed(parts.get(8 if kind == 3 else 9, b""), True))
                yield "way" if kind == 3 else "relation", parts[1], tags, None, None, refs


class Run(InputPartition):
    def __init__(self, places: list[tuple[int, int]]):
        self.places = places


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.per_task = options["path"], int(options.get("blobsPerTask", 8))
        self.kinds = frozenset(options["kinds"].split(",")) if options.get("kinds") else frozenset(KINDS.values())
        self.box = tuple(float(x) for x in options["box"].split(",")) if options.get("box") else None

    def wanted(self, row: tuple) -> bool:
        if self.box is None or row[0] != "node":
            return True
        west, south, east, north = self.box
        return west <= row[3] <= east and south <= row[4] <= north

    def partitions(self) -> list[Run]:
        data = [(at, n) for at, n, kind in blobs(self.path) if kind == "OSMData"]
        return [Run(data[i : i + self.per_task]) for i in range(0, len(data), self.per_task)] or [Run([])]

    def read(self, partition: Run) -> Iterator[tuple]:
        from gridloom.sources.tiff import _open

        with _open(self.path) as f:
            for at, n in partition.places:
                yield from filter(self.wanted, entities(inflate(f.read_at(n, at)), self.kinds))


class OsmSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "osmpbf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))


def read(spark: SparkSession, path: str, kinds: Sequence[str] = (), bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """The entities of an extract: of these kinds only, and nodes of the box only."""
    spark.dataSource.register(OsmSource)
    options = ({"kinds": ",".join(kinds)} if kinds else {}) | ({"box": ",".join(map(repr, bbox))} if bbox else {})
    return spark.read.format("osmpbf").options(**options).load(path)


def lines_of(spark: SparkSession, path: str, keep: F.Column, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """lines of an extract, each kind read by itself."""
    near = None if bbox is None else read(spark, path, ["node"], bbox)
    return _lines(read(spark, path, ["way"]), read(spark, path, ["node"]), keep, near)


def lines(entities: DataFrame, keep: F.Column, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """(id, tags, points) of the ways that keep selects; with a box, those with a point in it."""
    nodes = entities.filter("kind = 'node'")
    near = None if bbox is None else nodes.filter(F.col("lon").between(bbox[0], bbox[2]) & F.col("lat").between(bbox[1], bbox[3]))
    return _lines(entities.filter("kind = 'way'"), nodes, keep, near)


def _lines(ways: DataFrame, nodes: DataFrame, keep: F.Column, near: DataFrame | None) -> DataFrame:
    refs = ways.filter(keep).select("id", "tags", F.posexplode("refs").alias("k", "ref"))
    if near is not None:  # the box goes before the join of all points
        refs = refs.join(refs.join(near.select(F.col("id").alias("ref")), "ref", "left_semi").select("id").distinct(), "id", "left_semi")
    placed = refs.join(nodes.select(F.col("id").alias("ref"), "lon", "lat"), "ref")
    return placed.groupBy("id").agg(F.first("tags").alias("tags"), F.array_sort(F.collect_list(F.struct("k", "lon", "lat"))).alias("points"))


def padded(bbox: tuple[float, float, float, float], pad: float) -> tuple[float, float, float, float]:
    return bbox[0] - pad, bbox[1] - pad, bbox[2] + pad, bbox[3] + pad
