"""PNG pictures of small frames: the frame is decimated by Spark first, and only the picture reaches the driver."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 4096 * 4096


def encode(rgb: np.ndarray) -> bytes:
    """8-bit red, green and blue (row, col, 3) as a PNG."""
    height, width, _ = rgb.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = np.concatenate([np.zeros((height, 1), np.uint8), rgb.astype(np.uint8).reshape(height, -1)], axis=1)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def picture(frame: DataFrame, colour: str, width: int, height: int, path: str) -> None:
    """Writes frame (row, col, colour: array of three) as a picture; its size is checked before anything is collected."""
    if width * height > MOST:
        raise ValueError(f"a picture of {width} x {height} is too large; decimate it first")
    rows = frame.select("row", "col", *[F.col(colour)[i].alias(f"c{i}") for i in range(3)]).toPandas()
    rgb = np.zeros((height, width, 3), np.uint8)
    rgb[rows["row"], rows["col"]] = rows[["c0", "c1", "c2"]].to_numpy()
    with open(path, "wb") as f:
        f.write(encode(rgb))


def step_for(width: int, most: int = 1400) -> int:
    return max(width // most, 1)
