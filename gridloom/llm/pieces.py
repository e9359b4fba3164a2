"""SentencePiece encoding and decoding with spans in the original bytes.

A text is normalised by longest prefix through the model's compiled character map (a
double-array trie over UTF-8 bytes), and every normalised byte records the source byte
it came from. The library encodes; the pieces' lengths in normalised bytes add up to
positions, and the recorded alignment turns these into spans of the original bytes. The
encoder checks for each text that its pieces cover all normalised bytes. Models whose map is
empty and which keep white space (the identity rule) take a vectorised path.

Texts are encoded whole, a few at a time, so memory follows the longest text and not the batch.

Defined cases: null texts count as empty (no ids, the empty text back); ids may be null or
repeated; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import table

SPACE = "▁".encode()
AT_ONCE = 1 << 20  # bytes of text encoded in one call


def fields(blob: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a serialised message."""
    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (blob[i] & 127) << shift
            shift, i = shift + 7, i + 1
            if blob[i - 1] < 128:
                return value, i

    i = 0
    while i < len(blob):
        tag, i = varint(i)
        if tag & 7 == 0:
            value, i = varint(i)
        elif tag & 7 == 2:
            n, i = varint(i)
            value, i = blob[i : i + n], i + n
        else:
            n = 4 if tag & 7 == 5 else 8
            value, i = blob[i : i + n], i + n
        yield tag >> 3, value


class CharMap:
    """Longest-prefix lookup in a compiled character map: the trie's size, its units, then zero-ended replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0]
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest key that starts there, and the key's length."""
        node, found = 0, None
        node ^= self._offset(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (self.units[node] & 0x7FFFFFFF, i + 1 - at)
        if found is None:
            return None
        start = found[0]
        return self.texts[start : self.texts.index(b"\0", start)], found[1]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Normaliser:
    """Normalised bytes of a text and, for each of them and the end, the source byte."""

    def __init__(self, spec: bytes):
        got = dict(fields(spec))
        blob = got.get(2, b"")
        self.map = CharMap(blob) if blob else None
        self.dummy, self.squeeze, self.escape = bool(got.get(3, 1)), bool(got.get(4, 1)), bool(got.get(5, 1))

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        data = text.encode()
        if self.map is None and not self.squeeze and self.escape:
            return self._identity(data)
        return self._walk(data)

    def _identity(self, data: bytes) -> tuple[bytes, np.ndarray]:
        if not data:
            return b"", np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)
        source = np.repeat(np.arange(len(raw)), np.where(raw == 32, len(SPACE), 1))
        head = SPACE if self.dummy else b""
        return head + data.replace(b" ", SPACE), np.concatenate([np.zeros(len(head), np.int64), source, [len(raw)]])

    def _step(self, data: bytes, at: int) -> tuple[bytes, int]:
        hit = self.map.longest(data, at) if self.map else None
        if hit:
            return hit
        lead = data[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return data[at : at + n], n

    def _walk(self, data: bytes) -> tuple[bytes, np.ndarray]:
        out, source, at = bytearray(), [], 0
        space = SPACE if self.escape else b" "

        def put(piece: bytes, origin: int) -> None:
            out.extend(piece)
            source.extend([origin] * len(piece))

        if self.squeeze:
            while at < len(data):
                piece, n = self._step(data, at)
                if piece != b" ":
                    break
                at += n
        if at == len(data):
            return b"", np.array([at] if at else [0])
        if self.dummy:
            put(space, at)
        after_space = self.squeeze
        while at < len(data):
            piece, n = self._step(data, at)
            if after_space:
                piece = piece.lstrip(b" ")
            for part in (piece[i : i + 1] for i in range(len(piece))):
                put(space if part == b" " else part, at)
            if piece:
                after_space = self.squeeze and piece.endswith(b" ")
            at += n
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space) :]
                at = source[-len(space)]
                del source[-len(space) :]
        return bytes(out), np.array([*source, at])


class Codec:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as f:
            blob = f.read()
        self.processor = SentencePieceProcessor(model_proto=blob)
        parts = list(fields(blob))
        self.normaliser = Normaliser(next((v for k, v in parts if k == 3), b""))
        pieces = [dict(fields(v)) for k, v in parts if k == 1]
        self.widths = np.array([1 if p.get(3, 1) == 6 else len(p.get(1, b"")) for p in pieces])  # a byte piece is one byte
        self.unknown = {i for i, p in enumerate(pieces) if p.get(3, 1) == 2}
        self.names = [str(i) for i in range(len(pieces))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.processor.decode(ids, num_threads=1)

    def spans(self, text: str, ids: list[int]) -> np.ndarray:
        """A row (begin, end) of original bytes for each id."""
        data, source = self.normaliser(text)
        if self.unknown.intersection(ids):
            raise ValueError("an unknown piece has no fixed width; the model needs byte pieces")
        ends = np.cumsum(self.widths[ids]) if ids else np.zeros(0, np.int64)
        if (int(ends[-1]) if len(ends) else 0) != len(data):
            raise ValueError("pieces don't cover the normalised text")
        return np.stack([source[np.concatenate([[0], ends[:-1]]).astype(np.int64)] if ids else ends, source[ends]], axis=1) if ids else np.zeros((0, 2), np.int64)


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def runs(texts: list[str], most: int = AT_ONCE) -> Iterator[list[str]]:
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > most:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, begins, ends): every piece of every text with its span of original bytes."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path)
        for batch in batches:
            at = 0
            for run in runs(batch["text"].tolist()):
                ids = own.encode(run)
                spans = [own.spans(t, i) for t, i in zip(run, ids, strict=True)]
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[at : at + len(run)].astype("Int64").to_numpy(), "ids": ids, "begins": [s[:, 0] for s in spans], "ends": [s[:, 1] for s in spans]})
                at += len(run)

    return _plain(docs, id_col, text_col).mapInPandas(rows, "doc_id long, ids array<int>, begins array<long>, ends array<long>")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same in short: counts and hashes of ids, spans and the text decoded again."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            at = 0
            for run in runs(batch["text"].tolist()):
                ids = own.encode(run)
                spans = [own.spans(t, i) for t, i in zip(run, ids, strict=True)]
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[at : at + len(run)].astype("Int64").to_numpy(),
                    "n_tokens": [len(i) for i in ids],
                    "ids_sha256": [sha(",".join([own.names[x] for x in i])) for i in ids],
                    "decoded_sha256": [sha(t) for t in own.decode(ids)],
                    "n_bytes": [len(t.encode()) for t in run],
                    "spans_crc32": [zlib.crc32(s.astype("<i8").tobytes()) for s in spans],
                })
                at += len(run)

    return _plain(docs, id_col, text_col).mapInPandas(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long, spans_crc32 long")


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), model())
