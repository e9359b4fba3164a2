"""GeoTIFF as a source and a sink, classic or big: tiled or striped; plain, deflate, LZW or ZSTD; with either predictor.

The source plans one partition for each run of tiles that meets the wanted window, so a
window reads its own tiles' bytes and no others. Files are reached through Arrow's file
systems, by local path or uri.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gridloom.grid import Grid, Window
from gridloom.sources.files import arrow_uri, file_system
from gridloom.sources.scratch import discard, materialise

# Tags and field sizes of the file format.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_AT, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284
PREDICTOR, TILE_W, TILE_H, TILE_AT, TILE_BYTES, FORMAT, SCALE, TIEPOINT, GEOKEYS, NOTES, NODATA = 317, 322, 323, 324, 325, 339, 33550, 33922, 34735, 42112, 42113
PLAIN, LZW, DEFLATE, OLD_DEFLATE, ZSTD = 1, 5, 8, 32946, 50000
SIZES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q"}
KINDS = {1: "u", 2: "i", 3: "f"}
TILE = 512


@dataclass(frozen=True)
class Header:
    grid: Grid
    dtype: str
    bands: int
    planar: int
    predictor: int
    compression: int
    tile_w: int
    tile_h: int
    offsets: tuple[int, ...]
    lengths: tuple[int, ...]
    nodata: float | None
    order: str

    @property
    def across(self) -> int:
        return -(-self.grid.width // self.tile_w)

    @property
    def down(self) -> int:
        return -(-self.grid.height // self.tile_h)


def _open(path: str):
    from pyarrow import fs

    system, at = file_system(path) if re.match("[a-z0-9]+:/", path) else (fs.LocalFileSystem(), path)
    return system.open_input_file(at)


def read_header(path: str) -> Header:
    with _open(path) as f:
        head = f.read_at(16, 0)
        order = {b"II": "<", b"MM": ">"}.get(head[:2])
        version = struct.unpack(order + "H", head[2:4])[0] if order else 0
        if version not in (42, 43):
            raise ValueError(f"{path}: not a TIFF")
        # A classic file counts in 4 bytes and a big one in 8.
        wide, count_of, entry = ("I", "H", 12) if version == 42 else ("Q", "Q", 20)
        room, ahead = struct.calcsize(wide), struct.calcsize(order + count_of)
        at = struct.unpack(order + wide, head[4:8] if version == 42 else head[8:16])[0]
        n = struct.unpack(order + count_of, f.read_at(ahead, at))[0]
        directory = f.read_at(entry * n, at + ahead)
        tags: dict[int, tuple] = {}
        for i in range(0, entry * n, entry):
            tag, kind, count = struct.unpack(order + "HH" + wide, directory[i : i + 4 + room])
            one = struct.calcsize(SIZES[kind].replace("s", "c"))
            raw = directory[i + 4 + room : i + entry]
            if one * count > room:
                raw = f.read_at(one * count, struct.unpack(order + wide, raw)[0])
            tags[tag] = (raw[:count].rstrip(b"\0").decode(),) if kind == 2 else struct.unpack(order + SIZES[kind] * count, raw[: one * count])
    width, height, bands = tags[WIDTH][0], tags[HEIGHT][0], tags.get(SAMPLES, (1,))[0]
    scale, tie = tags.get(SCALE, (1.0, 1.0, 0.0)), tags.get(TIEPOINT, (0.0,) * 6)
    keys = tags.get(GEOKEYS, ())
    epsg = next((keys[i + 3] for i in range(4, len(keys), 4) if keys[i] in (3072, 2048)), 0)
    tiled = TILE_W in tags
    nodata = float(tags[NODATA][0]) if NODATA in tags else None
    return Header(
        Grid(epsg, tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1], scale[0], width, height), f"{KINDS[tags.get(FORMAT, (1,))[0]]}{tags.get(BITS, (8,))[0] // 8}", bands,
        tags.get(PLANAR, (1,))[0], tags.get(PREDICTOR, (1,))[0], tags.get(COMPRESSION, (1,))[0], tags[TILE_W][0] if tiled else width, tags[TILE_H][0] if tiled else tags.get(ROWS_PER_STRIP, (height,))[0],
        tags[TILE_AT if tiled else STRIP_AT], tags[TILE_BYTES if tiled else STRIP_BYTES], nodata, order,
    )


def unpack_lzw(blob: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bits first; 256 clears the table, 257 ends, and widths grow one code early."""
    first = [bytes([i]) for i in range(256)] + [b"", b""]
    table, width, before = list(first), 9, b""
    out, bits, have = bytearray(), 0, 0
    for byte in blob:
        bits, have = (bits << 8 | byte) & 0xFFFFFFFF, have + 8
        if have < width:
            continue
        have -= width
        code = bits >> have & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            table, width, before = list(first), 9, b""
            continue
        piece = table[code] if code < len(table) else before + before[:1]
        if before:
            table.append(before + piece[:1])
        out += piece
        before = piece
        width = min(12, max(9, (len(table) + 1).bit_length()))
    return bytes(out)


def unpacked(blob: bytes, compression: int, size: int) -> bytes:
    if compression == PLAIN:
        return blob
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(blob)
    if compression == LZW:
        return unpack_lzw(blob)
    if compression == ZSTD:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(blob, max_output_size=size)
    raise ValueError(f"compression {compression} isn't supported")


def decode(blob: bytes, h: Header, rows: int) -> np.ndarray:
    """(rows, tile_w, samples) of one tile or strip."""
    blob = unpacked(blob, h.compression, rows * h.tile_w * (h.bands if h.planar == 1 else 1) * np.dtype(h.dtype).itemsize)
    samples = h.bands if h.planar == 1 else 1
    size = np.dtype(h.dtype).itemsize
    if h.predictor == 3:
        planes = np.cumsum(np.frombuffer(blob, np.uint8).reshape(rows, h.tile_w * samples * size).reshape(rows, -1, samples), axis=1, dtype=np.uint8).reshape(rows, size, h.tile_w * samples)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(f">{h.dtype}").reshape(rows, h.tile_w, samples).astype(h.dtype)
    out = np.frombuffer(blob, h.order + h.dtype).reshape(rows, h.tile_w, samples).astype(h.dtype)
    return np.cumsum(out, axis=1, dtype=h.dtype) if h.predictor == 2 else out


def encode(tile: np.ndarray) -> bytes:
    """One band's tile: differences by rows for whole numbers, by byte planes for fractions, then deflate."""
    if tile.dtype.kind == "f":
        planes = np.ascontiguousarray(tile.astype(f">{tile.dtype.str[1:]}")).view(np.uint8).reshape(*tile.shape, -1).transpose(0, 2, 1).reshape(tile.shape[0], -1)
        planes = np.diff(planes, axis=1, prepend=np.zeros((len(planes), 1), np.uint8))
        return zlib.compress(planes.tobytes(), 6)
    return zlib.compress(np.diff(tile, axis=1, prepend=np.zeros((len(tile), 1), tile.dtype)).astype(tile.dtype).tobytes(), 6)


def to_bytes(bands: np.ndarray, grid: Grid, nodata: float | None = None) -> bytes:
    """Bands (band, row, col) as a tiled, deflated GeoTIFF."""
    count, height, width = bands.shape
    across, down = -(-width // TILE), -(-height // TILE)
    tiles = []
    for b in range(count):
        for r in range(down):
            for c in range(across):
                tile = np.zeros((TILE, TILE), bands.dtype.newbyteorder("<"))
                part = bands[b, r * TILE : (r + 1) * TILE, c * TILE : (c + 1) * TILE]
                tile[: part.shape[0], : part.shape[1]] = part
                tiles.append(encode(tile))
    at, offsets = 8, []
    for t in tiles:
        offsets.append(at)
        at += len(t)
    return struct.pack("<2sHI", b"II", 42, at) + b"".join(tiles) + directory(at, grid, bands.dtype, count, offsets, [len(t) for t in tiles], nodata)


def directory(at: int, grid: Grid, dtype: np.dtype, count: int, offsets: list[int], lengths: list[int], nodata: float | None, names: list[str] | None = None, big: bool = False) -> bytes:
    """The file's directory, which stands at ``at`` behind its tiles."""
    bits, form = dtype.itemsize * 8, {"u": 1, "i": 2, "f": 3}[dtype.kind]
    wide = "Q" if big else "I"
    fields = {
        WIDTH: ("I", [grid.width]), HEIGHT: ("I", [grid.height]), BITS: ("H", [bits] * count), COMPRESSION: ("H", [DEFLATE]), PHOTOMETRIC: ("H", [1]), SAMPLES: ("H", [count]), PLANAR: ("H", [2]), PREDICTOR: ("H", [3 if form == 3 else 2]),
        TILE_W: ("I", [TILE]), TILE_H: ("I", [TILE]), TILE_AT: (wide, offsets), TILE_BYTES: (wide, lengths), FORMAT: ("H", [form] * count), SCALE: ("d", [grid.res, grid.res, 0.0]),
        TIEPOINT: ("d", [0.0, 0.0, 0.0, grid.x0, grid.y0, 0.0]), GEOKEYS: ("H", [1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, grid.epsg]),
    }
    if names:
        fields[NOTES] = ("s", ["<GDALMetadata>" + "".join(f'<Item name="DESCRIPTION" sample="{i}" role="description">{n}</Item>' for i, n in enumerate(names)) + "</GDALMetadata>"])
    if nodata is not None:
        fields[NODATA] = ("s", [f"{nodata:g}"])
    codes, room = {"I": 4, "H": 3, "d": 12, "s": 2, "Q": 16}, struct.calcsize(wide)
    head = struct.pack("<Q" if big else "<H", len(fields))
    entries, extra, data_at = b"", b"", at + len(head) + (4 + 2 * room) * len(fields) + room
    for tag, (kind, values) in sorted(fields.items()):
        raw = (values[0].encode() + b"\0") if kind == "s" else struct.pack(f"<{len(values)}{kind}", *values)
        n = len(raw) if kind == "s" else len(values)
        entries += struct.pack(f"<HH{wide}", tag, codes[kind], n)
        if len(raw) > room:
            entries += struct.pack(f"<{wide}", data_at + len(extra))
            extra += raw + b"\0" * (-len(raw) % 8)
        else:
            entries += raw.ljust(room, b"\0")
    return head + entries + b"\0" * room + extra


def write_one(layer: DataFrame, values: list[str], grid: Grid, path: str, dtype: str, nodata: float, names: list[str] | None = None, big: bool | None = None) -> None:
    """A layer of any size as one tiled GeoTIFF. Tasks make the tiles; the driver appends them in order and holds one partition of them.

    Files that could pass 4 GB before compression are big ones, unless ``big`` says otherwise.
    """
    kind, across, down = np.dtype(dtype), -(-grid.width // TILE), -(-grid.height // TILE)
    big = grid.width * grid.height * len(values) * kind.itemsize > 4e9 if big is None else big

    def tile(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        top, left = int(key[0]) * TILE, int(key[1]) * TILE
        out = []
        for b, name in enumerate(values):
            part = np.full((TILE, TILE), nodata, kind)
            known = rows[name].notna().to_numpy()
            part[rows["row"].to_numpy()[known] - top, rows["col"].to_numpy()[known] - left] = rows[name].to_numpy()[known].astype(kind)
            out.append(((b * down + int(key[0])) * across + int(key[1]), encode(part)))
        return pd.DataFrame(out, columns=["number", "blob"])

    dealt = layer.select("row", "col", *values).groupBy(F.expr(f"CAST(row DIV {TILE} AS INT)").alias("tr"), F.expr(f"CAST(col DIV {TILE} AS INT)").alias("tc"))
    made = materialise(dealt.applyInPandas(tile, "number long, blob binary"), "tiles")
    empty = encode(np.full((TILE, TILE), nodata, kind))
    system, at_path = file_system(path)
    offsets, lengths = [], []
    with system.open_output_stream(f"{at_path}.part") as out:
        at = out.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 0) if big else struct.pack("<2sHI", b"II", 42, 0))

        def put(blob: bytes) -> None:
            nonlocal at
            offsets.append(at)
            lengths.append(len(blob))
            at += out.write(blob)

        for r in made.orderBy("number").toLocalIterator():
            while len(offsets) < r.number:
                put(empty)  # a tile without a pixel
            put(bytes(r.blob))
        while len(offsets) < across * down * len(values):
            put(empty)
        out.write(directory(at, grid, kind, len(values), offsets, lengths, nodata, names, big))
    # The head names the directory's place, which is known only now.
    head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, at) if big else struct.pack("<2sHI", b"II", 42, at)
    with system.open_input_stream(f"{at_path}.part") as old, system.open_output_stream(at_path) as new:
        old.read(len(head))
        new.write(head)
        while chunk := old.read(1 << 24):
            new.write(chunk)
    system.delete_file(f"{at_path}.part")
    discard(made)


def write(path: str, bands: np.ndarray, grid: Grid, nodata: float | None = None) -> None:
    """One file of an array in memory: for windows and previews."""
    with open(path, "wb") as f:
        f.write(to_bytes(bands, grid, nodata))


def write_stripes(layer: DataFrame, values: list[str], grid: Grid, folder: str, dtype: str, nodata: float, stripe: int = TILE) -> DataFrame:
    """A layer of any size as one GeoTIFF for each stripe of rows, written by the tasks to a shared folder.

    Returns (stripe, file) once run; a file's name is its stripe's, and a repeated task writes the same bytes.
    """
    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        top = int(key[0]) * stripe
        height = min(stripe, grid.height - top)
        bands = np.full((len(values), height, grid.width), nodata, dtype)
        for b, name in enumerate(values):
            known = rows[name].notna().to_numpy()
            bands[b, rows["row"].to_numpy()[known] - top, rows["col"].to_numpy()[known]] = rows[name].to_numpy()[known].astype(dtype)
        own = Grid(grid.epsg, grid.x0, grid.y0 - top * grid.res, grid.res, grid.width, height)
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        name = f"stripe-{int(key[0]):06d}.tif"
        with system.open_output_stream(f"{root}/{name}") as out:
            out.write(to_bytes(bands, own, nodata))
        return pd.DataFrame({"stripe": [int(key[0])], "file": [name]})

    arrow_uri(folder)  # a store that the tasks can't write to is refused here
    dealt = layer.select("row", "col", *values).withColumn("stripe", F.expr(f"CAST(row DIV {stripe} AS INT)"))
    return dealt.groupBy("stripe").applyInPandas(one, "stripe int, file string")


class Tiles(InputPartition):
    def __init__(self, numbers: list[int]):
        self.numbers = numbers


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.header = read_header(self.path)
        full = self.header.grid.full
        self.window = Window(*(int(options.get(k, getattr(full, k))) for k in ("col", "row", "width", "height")))
        self.per_task = int(options.get("tilesPerTask", 16))

    def partitions(self) -> list[Tiles]:
        h, w = self.header, self.window
        rows = range(w.row // h.tile_h, min(h.down, -(-(w.row + w.height) // h.tile_h)))
        cols = range(w.col // h.tile_w, min(h.across, -(-(w.col + w.width) // h.tile_w)))
        wanted = [r * h.across + c for r in rows for c in cols]
        return [Tiles(wanted[i : i + self.per_task]) for i in range(0, len(wanted), self.per_task)] or [Tiles([])]

    def read(self, partition: Tiles) -> Iterator:
        import pyarrow as pa

        h, w = self.header, self.window
        with _open(self.path) as f:
            for number in partition.numbers:
                top, left = number // h.across * h.tile_h, number % h.across * h.tile_w
                rows = h.tile_h if h.tile_w != h.grid.width or h.down * h.tile_h == h.grid.height or len(h.offsets) == 1 else min(h.tile_h, h.grid.height - top)
                places = [number] if h.planar == 1 else [b * h.across * h.down + number for b in range(h.bands)]
                parts = [decode(f.read_at(h.lengths[p], h.offsets[p]), h, rows) for p in places]
                tile = np.concatenate(parts, axis=2)
                r0, r1 = max(w.row, top), min(w.row + w.height, top + rows, h.grid.height)
                c0, c1 = max(w.col, left), min(w.col + w.width, left + h.tile_w, h.grid.width)
                cut = tile[r0 - top : r1 - top, c0 - left : c1 - left].astype(np.float64)
                rr, cc = np.mgrid[r0:r1, c0:c1]
                columns = [pa.array(rr.ravel(), pa.int32()), pa.array(cc.ravel(), pa.int32())]
                for b in range(h.bands):
                    v = cut[:, :, b].ravel()
                    missing = np.isnan(v) if h.nodata is None else np.isnan(v) | (v == h.nodata)
                    columns.append(pa.array(v, pa.float64(), mask=missing))
                yield pa.RecordBatch.from_arrays(columns, names=["row", "col", *[f"band{b + 1}" for b in range(h.bands)]])


class TiffSource(DataSource):
    """spark.read.format("gridtiff").load(path): row, col and band1.. as doubles; nodata is null."""

    @classmethod
    def name(cls) -> str:
        return "gridtiff"

    def schema(self) -> str:
        return ", ".join(["row int", "col int", *[f"band{b + 1} double" for b in range(read_header(self.options["path"]).bands)]])

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))


def read(spark: SparkSession, path: str, window: Window | None = None) -> DataFrame:
    spark.dataSource.register(TiffSource)
    options = {} if window is None else {k: str(getattr(window, k)) for k in ("col", "row", "width", "height")}
    return spark.read.format("gridtiff").options(**options).load(path)


def bands_named(names: list[str], wanted: list[str | int] | None) -> list[int]:
    """1-based band numbers for names or numbers; without a wish one band gives [1], more give [1, 2, 3]."""
    if wanted is None:
        return [1] if len(names) < 3 else [1, 2, 3]
    out = []
    for w in wanted:
        n = int(w) if str(w).isdigit() else names.index(w) + 1 if w in names else 0
        if not 1 <= n <= len(names):
            raise ValueError(f"no band {w!r}; there are {names}")
        out.append(n)
    return out
