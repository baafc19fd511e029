"""BPE encoding as a bounded-lookahead transducer, and decoding as a byte-to-text state machine.

Merges are applied lowest rank first, so text far to the right cannot change a token on the left: a
symbol is lost to its right neighbour only through a chain of ever earlier merges that overlap. The
longest such chain of a merge list is its sufficient lookahead. The encoder keeps one window of symbols
and emits every token that ends at least that far before the window's end.

Defined results: null text counts as empty and gives no ids; very long words need one window of memory,
not one word; the literal special tokens of the vocabulary become their ids wherever they occur, as the
tokenizers library does. Rows are independent: repeated rows repeat and null ids stay null.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import sys
from array import array
from collections.abc import Iterable, Iterator
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from runlens.llm.shared import SMALL_BATCH, map_arrow

# Chunks between white space whose ids a worker remembers.
MEMO_CHUNKS = 400_000
# Longer chunks pass through the transducer without being remembered.
MEMO_LENGTH = 64
_NO_MERGE = 1 << 62

# The word pattern of the vocabulary's file.
_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+"
# Latin text is its own NFC, and all Unicode versions class its characters alike; other text goes through
# the library's own normalizer and word splitter.
_BEYOND_LATIN = regex.compile(r"[^\x00-\x1b\x20-\u024f\u2010-\u2027\u20ac]")


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    letters, extra = [], 256
    for byte in range(256):
        if byte in shown:
            letters.append(chr(byte))
        else:
            letters.append(chr(extra))
            extra += 1
    return letters


def sufficient_lookahead(merges: list[tuple[str, str]], base: Iterable[str]) -> int:
    """How many symbols to the right of a token can still decide whether it stays, over all texts.

    `reach[s]`: symbols needed to know whether the right neighbour takes s, by merges seen so far;
    `forming[s]`: the same for the last parts of s while s is being formed.
    """
    length = dict.fromkeys(base, 1)
    reach: dict[str, int] = {}
    forming: dict[str, int] = {}
    for left, right in merges:
        joined = left + right
        length[joined] = length.get(left, 1) + length.get(right, 1)
        forming[joined] = max(forming.get(joined, 0), forming.get(right, 0), reach.get(right, 0))
        needed = length.get(right, 1) + max(forming.get(right, 0), reach.get(right, 0))
        reach[left] = max(reach.get(left, 0), needed)
    return max([0, *reach.values(), *forming.values()])


class Vocabulary:
    """Merges, ids and pieces of a BPE file of the tokenizers library with an end-of-word suffix."""

    def __init__(self, definition: str):
        held = json.loads(definition)
        model = held["model"]
        ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        names = {i: token for token, i in ids.items()} | {i: token for token, i in self.special.items()}
        self.pieces = [names.get(i, "") for i in range(max(names) + 1)]
        self.sizes = [len(piece.removesuffix(self.suffix) or piece) for piece in self.pieces]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merged = [ids[left + right] for left, right in pairs]
        self.ranks = {ids[left] << 32 | ids[right]: rank for rank, (left, right) in enumerate(pairs)}
        # Ids of single bytes inside a word and at its end; the library skips symbols without an id.
        self.inner = [ids.get(letter, -1) for letter in byte_letters()]
        self.last = [ids.get(letter + self.suffix, -1) for letter in byte_letters()]
        base = [token for token, i in ids.items() if self.sizes[i] == 1]
        self.lookahead = sufficient_lookahead(pairs, base)
        # A window always holds a whole token and its lookahead, so every full window emits something.
        self.window = 2 * (self.lookahead + max(self.sizes))
        library = Tokenizer.from_str(definition)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer


def _little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


class Encoder:
    """Feeds words to the transducer and remembers the ids of short chunks between white space."""

    def __init__(self, vocabulary: Vocabulary):
        self.of = vocabulary
        self.values = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.memo: dict[str, bytes] = {}
        self.piece = regex.compile(_PIECE)
        special = "|".join(regex.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True))
        self.split = regex.compile(f"({special})") if special else None

    def _merge(self, symbols: list[int]) -> list[int]:
        """Join the pair of lowest rank, leftmost first, until no pair of the merge list is left."""
        rank_of, merged = self.of.ranks.get, self.of.merged
        ranks = [rank_of(a << 32 | b, _NO_MERGE) for a, b in pairwise(symbols)]
        while ranks:
            best = min(ranks)
            if best == _NO_MERGE:
                break
            place = ranks.index(best)
            joined = symbols[place] = merged[best]
            del symbols[place + 1], ranks[place]
            if place < len(ranks):
                ranks[place] = rank_of(joined << 32 | symbols[place + 1], _NO_MERGE)
            if place:
                ranks[place - 1] = rank_of(symbols[place - 1] << 32 | joined, _NO_MERGE)
        return symbols

    def transduce(self, symbols: Iterable[int]) -> Iterator[int]:
        """A window of symbols, stable tokens out; what may still change stays in the window."""
        window: list[int] = []
        sizes, lookahead, full = self.of.sizes, self.of.lookahead, self.of.window
        for symbol in symbols:
            window.append(symbol)
            if len(window) >= full:
                read, end = 0, len(window) - lookahead
                for token in self._merge(window[:]):
                    if read + sizes[token] > end:
                        break
                    yield token
                    read += sizes[token]
                del window[:read]
        yield from self._merge(window)

    def _word(self, word: str) -> Iterable[int]:
        raw = word.encode()
        symbols = [self.of.inner[byte] for byte in raw[:-1]]
        symbols.append(self.of.last[raw[-1]])
        if -1 in symbols:
            symbols = [symbol for symbol in symbols if symbol >= 0]
        # A word within one window is flushed at once.
        return self._merge(symbols) if len(symbols) < self.of.window else self.transduce(symbols)

    def _words(self, words: Iterable[str]) -> bytes:
        out = array("I")
        for word in words:
            out.extend(self._word(word))
        return _little_endian(out)

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a lower-case Latin chunk without white space; words never reach over white space."""
        ids = self._words([chunk] if chunk.isalpha() else self.piece.findall(chunk))
        if len(chunk) <= MEMO_LENGTH:
            if len(self.memo) >= MEMO_CHUNKS:
                self.memo.clear()
            self.memo[chunk] = ids
        return ids

    def _part(self, text: str) -> bytes:
        if _BEYOND_LATIN.search(text):
            split = self.of.splitter.pre_tokenize_str(self.of.normalizer.normalize_str(text))
            return self._words(bytes(map(self.values.__getitem__, letters)).decode() for letters, _ in split)
        chunks = text.lower().split()
        found = list(map(self.memo.get, chunks))
        if None in found:
            found = [self._chunk(chunk) if ids is None else ids for chunk, ids in zip(chunks, found, strict=True)]
        return b"".join(found)

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts = self.split.split(text) if self.split else [text]
        special = self.of.special
        return b"".join(
            special[part].to_bytes(4, "little") if part in special else self._part(part) for part in parts
        )


class Decoder:
    """Turns ids into text piece by piece.

    With `joined`, pieces are joined by spaces, as the library does for a file without a decoder.
    Otherwise the bytes behind the pieces pass through an incremental UTF-8 machine, which holds back the
    bytes of an unfinished character and replaces broken ones.
    """

    def __init__(self, vocabulary: Vocabulary, joined: bool = True):
        self.joined, self.begun = joined, False
        pieces = vocabulary.pieces
        if joined:
            self.bytes = [piece.encode() for piece in pieces]
        else:
            value = {letter: byte for byte, letter in enumerate(byte_letters())}
            plain = [p.removesuffix(vocabulary.suffix) + " " * p.endswith(vocabulary.suffix) for p in pieces]
            self.bytes = [
                b"".join(bytes([value[c]]) if c in value else c.encode() for c in piece) for piece in plain
            ]
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        parts = [self.bytes[i] for i in ids]
        if not self.joined:
            return self.machine.decode(b"".join(parts))
        if not parts:
            return ""
        lead, self.begun = b" " if self.begun else b"", True
        return self.machine.decode(lead + b" ".join(parts))

    def finish(self) -> str:
        rest, self.begun = self.machine.decode(b"", True), False
        self.machine.reset()
        return rest


# Ids that the decoder takes at a time.
_FEED = 65_536
_LOADED: dict[str, tuple[Encoder, Decoder]] = {}


def _tools(definition: str) -> tuple[Encoder, Decoder]:
    """One encoder and decoder per worker and file, so that words stay remembered across tasks."""
    if definition not in _LOADED:
        vocabulary = Vocabulary(definition)
        _LOADED[definition] = Encoder(vocabulary), Decoder(vocabulary)
    return _LOADED[definition]


def _shipped(docs: DataFrame, path: str):
    """The vocabulary file, read once by the driver."""
    return docs.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    definition = _shipped(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(definition.value)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column("text"):
                ids = encoder.encode(text.as_py())
                decoded = hashlib.sha256()
                for start in range(0, len(ids), 4 * _FEED):
                    held = np.frombuffer(ids, "<u4", min(_FEED, (len(ids) - start) // 4), start)
                    decoded.update(decoder.feed(held.tolist()).encode())
                decoded.update(decoder.finish().encode())
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(decoded.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, the ids and the text they decode to."""
    definition = _shipped(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(definition.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [np.frombuffer(encoder.encode(text.as_py()), "<u4") for text in part.column("text")]
                values = np.concatenate([np.zeros(0, np.uint32), *ids])
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                texts = [decoder.feed(x.tolist()) + decoder.finish() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(list(map(len, ids)), pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int32), pa.int32())),
                        pa.array(texts, pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "input_ids", "decoded"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, run, "doc_id long, n_tokens long, input_ids array<int>, decoded string", SMALL_BATCH)
