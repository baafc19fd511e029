import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from runlens.llm import bpe, huffman, token_files
from runlens.llm.shared import fresh_path
from tests.llm.cases import frame, odd, words

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rnd = random.Random(3)
    pools = ["aeiouthrnsé'ñÜİΣς ß漢字٣½²   \x1c\x85 Ǆﬁ<|>endoftext.,!?0123\n\t🙂é́\x1d", "ab.,'é \n1"]
    out = ["", " ", "\n", "a\n", "\na", " a", "a ", "<|endoftext|>", "a<|endoftext|>\nb <|startoftext|>", "the" * 2000, words(1, 3000)]
    out += ["".join(rnd.choice(rnd.choice(pools)) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    out += ["".join(rnd.choice("thein") for _ in range(4000)), "a" * 5000]
    return out


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(open(WORD, encoding="utf-8").read())


def test_transducer_is_the_library(vocabulary):
    library, encoder, decoder = Tokenizer.from_file(WORD), bpe.Encoder(vocabulary), bpe.Decoder(vocabulary)
    for text in texts():
        want = library.encode(text, add_special_tokens=False).ids
        got = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert got == want
        assert decoder.feed(got) + decoder.finish() == library.decode(want, skip_special_tokens=False)


def test_windows_change_nothing(vocabulary):
    encoder = bpe.Encoder(vocabulary)
    rnd = random.Random(5)
    letters = [i for i in vocabulary.inner if i >= 0]
    for _ in range(200):
        symbols = [rnd.choice(letters) for _ in range(rnd.randint(0, 3 * vocabulary.window))]
        assert list(encoder.transduce(iter(symbols))) == encoder._merge(symbols[:])


def test_byte_machine_holds_back_unfinished_characters(vocabulary):
    decoder = bpe.Decoder(vocabulary, joined=False)
    ids = np.frombuffer(bpe.Encoder(vocabulary).encode("straße 漢字 🙂"), "<u4").tolist()
    parts = [decoder.feed([i]) for i in ids]
    assert "".join(parts) + decoder.finish() == "straße 漢字 🙂 "
    assert "�" not in "".join(parts)


def test_bpe_rows(spark):
    docs = odd(spark)
    got = bpe.digests(docs, WORD).collect()
    library = Tokenizer.from_file(WORD)
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert bpe.digests(docs.limit(0), WORD).count() == 0
    whole = {r.doc_id: r for r in bpe.encoded(docs, WORD).collect()}
    assert whole[1].input_ids == library.encode(whole[1].decoded and docs.where("doc_id = 1").first().text, add_special_tokens=False).ids
    assert whole[3].input_ids == [] and whole[3].decoded == ""


def test_chunked_encoding_is_the_library():
    library, encoder = Tokenizer.from_file(BYTE), token_files.TextEncoder(open(BYTE, encoding="utf-8").read())
    for text in texts():
        assert np.frombuffer(encoder.encode(text), encoder.width).tolist() == [*library.encode(text, add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("symbols", [1, 2, 5, 300, 5000])
def test_huffman_round_trip_and_limit(symbols):
    rng = np.random.default_rng(symbols)
    counts = np.floor(1e6 / np.arange(1, symbols + 1) ** 2 + 1).astype(np.int64)
    limit = huffman.length_limit(symbols)
    lengths = huffman.code_lengths(counts, limit)
    assert lengths.max() <= limit and (2.0 ** -lengths.astype(float)).sum() <= 1
    book = huffman.Codebook(lengths)
    sizes = np.array([0, 1, 255, 256, 257, 3000])
    ids = rng.integers(0, symbols, sizes.sum()).astype(np.uint32)
    packed, n_bytes, marks = book.encode(ids, sizes)
    starts = np.concatenate([[0], np.cumsum(n_bytes)[:-1]]) * 8
    lanes = [min(huffman.LANE, n - k) for n in sizes.tolist() for k in range(0, n, huffman.LANE)]
    at = np.concatenate([m + s for m, s in zip(marks, starts, strict=True)])
    assert (book.decode(packed, at, np.array(lanes)) == ids).all()


def test_length_limited_codes_are_optimal():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    free = huffman.code_lengths(counts, 16)
    import heapq

    heap = [(int(c), i) for i, c in enumerate(counts)]
    cost = 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], 99))
    assert (free * counts).sum() == cost
    assert huffman.code_lengths(counts, 4).max() == 4


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_DOCUMENTS", 4)
    monkeypatch.setattr(token_files, "BLOCK_IDS", 50)
    docs = odd(spark)
    folder = fresh_path(spark, "files")
    token_files.write_files(docs, BYTE, folder)
    got = token_files.read_digests(spark, folder).collect()
    library = Tokenizer.from_file(BYTE)
    ids = {}
    for r in docs.collect():
        ids.setdefault(r.doc_id, []).append([*library.encode(r.text or "", add_special_tokens=False).ids, 0])
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
        crcs = [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[r.doc_id]]
        assert (r.n_tokens, r.ids_crc32) in crcs
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order[:2] == [None, None] and order[2:] == sorted(order[2:]) and len(order) == docs.count()
    empty = fresh_path(spark, "files")
    token_files.write_files(frame(spark, []), BYTE, empty)
    assert token_files.read_digests(spark, empty).count() == 0
