import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceNormalizer, SentencePieceProcessor
from tokenizers import Tokenizer

from gridloom.llm import packing, pieces


def plain_pieces(texts):
    t = Tokenizer.from_file(packing.vocabulary())
    out = []
    for i, text in enumerate(texts):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        n = len(ids)
        at = [0] if n <= 1024 else sorted({0, *range(n % 1024, n, 1024)})
        out += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(at, [*at[1:], n]))]
    return out


def test_pieces_and_sequences(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = packing.pack(df, packing.vocabulary()).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == plain_pieces(texts)
    whole = {}
    for r in rows:
        whole.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in whole.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= 1024


def test_packing_cases(spark, docs, empty):
    rows = packing.pack(docs.withColumn("piece", F.lit("x")), packing.vocabulary(), group=7).collect()
    assert sum(r.doc_id == 6 and r.piece == 0 for r in rows) == 3 and sum(r.doc_id is None for r in rows) == 2
    assert len({r.sequence_id >> 32 for r in rows if r.length < 1024}) > 1
    assert packing.pack(empty, packing.vocabulary()).count() == 0


def test_each_choice_makes_the_sum_of_squares_smallest():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 33, 300)
    seq, off, made = packing.sum_of_squares(sizes, np.arange(300), 32)
    gaps = {}
    total = lambda g: sum(n * n for n in np.bincount([x for x in g.values() if 0 < x < 32], minlength=33))
    for i, s in enumerate(sizes):
        options = [total(gaps | {b: g - s}) for b, g in gaps.items() if g >= s] + [total(gaps | {10_000: 32 - s})]
        assert off[i] == 32 - gaps.get(seq[i], 32)
        gaps[seq[i]] = gaps.get(seq[i], 32) - s
        assert total(gaps) == min(options)
    assert made == len(gaps)


def test_few_sequences():
    rng = np.random.default_rng(1)
    sizes = np.minimum(rng.lognormal(5.5, 1, 20_000).astype(int) + 1, 1024)
    _, _, made = packing.pack_sizes(sizes, rng.permutation(len(sizes)))
    assert made <= 1.01 * -(-sizes.sum() // 1024)


def test_codec_equals_the_library(spark, docs, texts):
    sp = SentencePieceProcessor(model_file=pieces.model())
    rows = {r.doc_id: r for r in pieces.digests(docs, pieces.model()).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, t in enumerate(texts):
        ids = sp.encode(t or "")
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))


def test_spans_cover_the_bytes_and_show_the_pieces(spark, texts):
    c = pieces.codec(pieces.model())
    for t in ["Hello  world é漢😀\n x", " a", *[x for x in texts if x and len(x) < 5000]]:
        ids, data = c.encode([t])[0], t.encode()
        spans = c.spans(t, ids)
        assert spans[0][0] == 0 and spans[-1][1] == len(data) and (spans[1:, 0] == spans[:-1, 1]).all()
        for i, (a, b) in zip(ids, spans):
            piece = c.processor.id_to_piece(i)
            if not piece.startswith("<0x"):
                assert data[a:b].decode().lstrip(" ") == piece.replace("▁", " ").lstrip(" ")
    rows = pieces.encode(spark.createDataFrame([(1, "Hello world"), (2, None)], "doc_id long, text string"), pieces.model()).collect()
    assert rows[0].ends[-1] == 11 and rows[1].ids == []


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_normaliser_equals_the_library(rule):
    lib = SentencePieceNormalizer(rule_name=rule)
    spec = next(v for k, v in pieces.fields(lib.serialized_model_proto()) if k == 3)
    own = pieces.Normaliser(spec)
    for t in ["", " ", "a", "ｶﾞ ①  x", "  lead and trail  ", "ﬁne Ⅷ ½ ﷺ é\u0301", "Ａ\u200bB\u00a0C", "İstanbul ß", "漢字 ｱｲｳ 👩‍👩‍👧", "tab\tnew\nline", "\u0344\u0385"]:
        want, at = lib.normalize(t, with_offsets=True)
        data, source = own(t)
        assert data.decode() == want, (rule, t)
        if want:
            chars = np.cumsum([0, *(len(c.encode()) for c in want)])
            to_char = {len(t[:i].encode()): i for i in range(len(t) + 1)}
            assert [to_char[int(source[p])] for p in chars] == list(at), (rule, t)


def test_vocabulary_is_a_parameter(tmp_path):
    import shutil

    shutil.copy(public_tokenizers.path("byte_bpe_50k.json"), tmp_path / "own.json")  # without ranks beside it the JSON tokenizer itself runs
    slow, fast = packing.Encoder(str(tmp_path / "own.json")), packing.encoder(packing.vocabulary())
    assert slow.fast is None and slow("Some text <|endoftext|> é").tolist() == fast("Some text <|endoftext|> é").tolist()
