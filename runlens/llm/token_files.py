"""Token ids in compact files: ids of all documents in ascending doc_id order, Huffman-coded in blocks.

A folder holds `codebook` (id, length) and `blocks`: one row per block with its file number, its place in
the file, the ids of its documents, their token counts, the bit checkpoints and the packed codes. Blocks
decode independently of each other. Ids are counted over the whole corpus before any is coded.

Defined results: null text counts as empty; every document ends with the id 0, so an empty one has one
id. Rows without a doc_id come first. Repeated ids are separate documents, ordered by their packed codes.
An empty table gives an empty codebook and no blocks.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from runlens.llm.bpe import byte_letters
from runlens.llm.huffman import LANE, Codebook, code_lengths, length_limit
from runlens.llm.shared import map_arrow, stored

END_ID = 0
# A block is closed at the document that fills it.
BLOCK_IDS = 65_536
# Documents per file aimed at, and files at most; a file only grows beyond that.
FILE_DOCUMENTS = 8_192
MAX_FILES = 16_384
# Ids handled at a time, and chunks of text whose ids a worker remembers.
SLICE_IDS = 500_000
MEMO_CHUNKS = 700_000
MEMO_LENGTH = 64

_LOADED: dict[int, tuple[Tokenizer, dict[str, bytes]]] = {}
# A blank between two other characters always begins a new word of the byte-level splitter.
_CUT = re.compile(r"(?<=\S)(?= \S)")
_ODD_SPACE = re.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# Marks a chunk that has no blank before it; it occurs in no text that is cut at its blanks.
_BARE = "\x1d"
_MARKS = frozenset(".,;:!?")
# Letters on which all Unicode versions agree.
_LETTERS = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def _chunks(text: str) -> list[str]:
    """Parts of a text that the tokenizer encodes independently; those without `_BARE` follow a blank.

    A line break between two other characters is a word of its own.
    """
    if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] == " " or text[-1:] == " " or _ODD_SPACE.search(text):
        return [_BARE + chunk for chunk in _CUT.split(text)]
    chunks = text.replace("\n", f" {_BARE}\n {_BARE}").split(" ")
    chunks[0] = _BARE + chunks[0]
    return chunks


class ChunkIds(dict):
    """Ids of chunks as packed bytes: a chunk seen for the first time goes to the tokenizers library."""

    def __init__(self, tokenizer: Tokenizer, width: str):
        super().__init__()
        self.tokenizer, self.code = tokenizer, "H" if width == "<u2" else "I"
        self.letters = dict(enumerate(byte_letters()))
        self.blank = self.letters[ord(" ")]

    def _packed(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def __missing__(self, chunk: str) -> bytes:
        bare = chunk[0] == _BARE
        plain = chunk[1:] if bare else chunk
        if _LETTERS.fullmatch(plain):
            # Letters, with the blank before them, are one word, which the model takes as it is.
            raw = plain if plain.isascii() else plain.encode().decode("latin-1").translate(self.letters)
            raw = raw if bare else self.blank + raw
            ids = self._packed([token.id for token in self.tokenizer.model.tokenize(raw)])
        elif plain[-1:] in _MARKS and _LETTERS.fullmatch(plain[:-1]):
            # A mark after letters is a word of its own.
            ids = self[chunk[:-1]] + self[_BARE + plain[-1]]
        else:
            ids = self._packed(self.tokenizer.encode(plain if bare else " " + plain, add_special_tokens=False).ids)
        if len(chunk) <= MEMO_LENGTH:
            self[chunk] = ids
        return ids


class TextEncoder:
    """The tokenizers library over chunks; chunks seen before are remembered, up to a bound."""

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tokenizer = Tokenizer.from_str(definition)
        self.width = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.end = np.array([END_ID], dtype=self.width).tobytes()
        self.ids = ChunkIds(tokenizer, self.width)

    def encode(self, text: str) -> bytes:
        """Ids of a text, end id included, in the narrowest width that holds the vocabulary."""
        if len(self.ids) > MEMO_CHUNKS:
            self.ids.clear()
        return b"".join(map(self.ids.__getitem__, _chunks(text))) + self.end


def _text_encoder(definition: str) -> TextEncoder:
    """One per worker and tokenizer, so that chunks stay remembered across tasks."""
    if definition not in _LOADED:
        _LOADED[definition] = TextEncoder(definition)
    return _LOADED[definition]


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `most` in sum, one row at least."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids of every row as packed integers, written to the shared folder."""
    definition = docs.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _text_encoder(definition.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids = [encoder.encode(text.as_py() or "") for text in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(map_arrow(rows, run, "doc_id long, ids binary"), "ids", compression="zstd")


def _count(width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                found = np.bincount(np.frombuffer(ids.as_buffer(), dtype=width))
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), dtype=np.int64)])
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["id", "n"])

    return run


def _write_codebook(ids: DataFrame, width: str, folder: str) -> Codebook:
    """Code lengths from the counts over all documents; no more rows than the vocabulary has ids."""
    counts = map_arrow(ids.select("ids"), _count(width), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    by_id = np.zeros(int(found["id"].max()) + 1 if len(found) else 1, dtype=np.int64)
    by_id[found["id"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    lengths = code_lengths(by_id, length_limit(len(found)))
    used = np.flatnonzero(lengths)
    rows = [(int(i), int(lengths[i])) for i in used]
    ids.sparkSession.createDataFrame(rows, "id long, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    return Codebook(lengths)


def read_codebook(spark: SparkSession, folder: str) -> Codebook:
    found = spark.read.parquet(f"{folder}/codebook").toPandas()
    lengths = np.zeros(int(found["id"].max()) + 1 if len(found) else 1, dtype=np.uint8)
    lengths[found["id"].to_numpy(dtype=np.int64)] = found["length"].to_numpy()
    return Codebook(lengths)


_CODED = "doc_id long, n int, packed binary, checkpoints binary"
_BLOCK = "file int, block int, first long, n_ids long, doc_ids binary, counts binary, checkpoints binary, packed binary"


def _coder(book, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.dtype(width).itemsize
        for batch in batches:
            held = [ids.as_buffer() for ids in batch.column("ids")]
            for start, end in _slices([len(x) // size for x in held], SLICE_IDS):
                counts = np.array([len(x) // size for x in held[start:end]], dtype=np.int64)
                ids = np.frombuffer(b"".join(held[start:end]), dtype=width)
                packed, sizes, checkpoints = book.value.encode(ids, counts)
                stops = np.cumsum(sizes).tolist()
                parts = [packed[a:b] for a, b in zip([0, *stops], stops, strict=False)]
                marks = [c.astype("<i8").tobytes() for c in checkpoints]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, end - start),
                        pa.array(counts.astype(np.int32)),
                        pa.array(parts, pa.binary()),
                        pa.array(marks, pa.binary()),
                    ],
                    names=["doc_id", "n", "packed", "checkpoints"],
                )

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gather the sorted documents of each file into blocks."""
    file, block, first = -1, 0, 0
    held: list[tuple[int | None, int, bytes, bytes]] = []

    def close() -> pa.RecordBatch:
        counts = np.array([n for _, n, _, _ in held], dtype="<i8")
        sizes = np.array([len(packed) for _, _, packed, _ in held], dtype=np.int64)
        starts = (np.cumsum(sizes) - sizes) * 8
        marks = [np.frombuffer(c, "<i8") + s for (_, _, _, c), s in zip(held, starts.tolist(), strict=True)]
        ids = pa.array([doc_id for doc_id, _, _, _ in held], pa.int64())
        known = np.array([doc_id is not None for doc_id, _, _, _ in held], dtype="<i8")
        return pa.RecordBatch.from_arrays(
            [
                pa.array([file], pa.int32()),
                pa.array([block], pa.int32()),
                pa.array([first], pa.int64()),
                pa.array([int(counts.sum())], pa.int64()),
                pa.array([known.tobytes() + ids.fill_null(0).to_numpy().astype("<i8").tobytes()], pa.binary()),
                pa.array([counts.tobytes()], pa.binary()),
                pa.array([np.concatenate(marks).astype("<i8").tobytes()], pa.binary()),
                pa.array([b"".join(packed for _, _, packed, _ in held)], pa.binary()),
            ],
            names=["file", "block", "first", "n_ids", "doc_ids", "counts", "checkpoints", "packed"],
        )

    size = 0
    for batch in batches:
        columns = [batch.column(c) for c in ("file", "doc_id", "n", "packed", "checkpoints")]
        for row in zip(*columns, strict=True):
            number, doc_id, n, packed, marks = (x.as_py() for x in row)
            if held and (number != file or size >= BLOCK_IDS):
                yield close()
                block, first, size, held = block + 1, first + size, 0, []
            if number != file:
                file, block, first = number, 0, 0
            held.append((doc_id, n, packed, marks))
            size += n
    if held:
        yield close()


def write_files(docs: DataFrame, tokenizer: str, folder: str) -> None:
    """Encode the texts of `docs` and write them below `folder`, in ascending doc_id order."""
    spark = docs.sparkSession
    ids = tokenized(docs, tokenizer)
    width = TextEncoder(Path(tokenizer).read_text(encoding="utf-8")).width
    book = spark.sparkContext.broadcast(_write_codebook(ids, width, folder))
    coded = map_arrow(ids, _coder(book, width), _CODED)
    files = min(MAX_FILES, 1 + ids.count() // FILE_DOCUMENTS)
    shares = [i / files for i in range(1, files)]
    found = ids.agg(F.percentile_approx("doc_id", shares, 5 * files)).first()[0] if shares else None
    borders = sorted(set(found or []))
    file = F.size(F.filter(F.lit(borders).cast("array<bigint>"), lambda b: b <= F.col("doc_id"))) if borders else F.lit(0)
    file = F.when(F.col("doc_id").isNull(), 0).otherwise(file)
    placed = coded.withColumn("file", file.cast("int")).repartition(files, "file")
    ordered = placed.sortWithinPartitions("file", F.col("doc_id").asc_nulls_first(), "packed")
    map_arrow(ordered, _blocks, _BLOCK).write.option("compression", "none").parquet(f"{folder}/blocks")


def _reader(book):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 8):
                yield from _read_blocks(batch.slice(start, 8), book.value)

    return run


def _read_blocks(part: pa.RecordBatch, book: Codebook) -> Iterator[pa.RecordBatch]:
    column = {name: part.column(name).to_pylist() for name in part.schema.names}
    counts = [np.frombuffer(c, "<i8") for c in column["counts"]]
    starts = np.cumsum([0, *(8 * len(p) for p in column["packed"])])
    marks = [np.frombuffer(c, "<i8") + s for c, s in zip(column["checkpoints"], starts.tolist(), strict=False)]
    lanes = []
    for n in np.concatenate(counts).tolist():
        full, rest = divmod(n, LANE)
        lanes += [LANE] * full + [rest] * (rest > 0)
    ids = book.decode(b"".join(column["packed"]), np.concatenate(marks), np.array(lanes, dtype=np.int64))
    raw, at = memoryview(ids.astype("<u4").tobytes()), 0
    rows: list[tuple] = []
    for i, of_block in enumerate(counts):
        known, doc_ids = np.frombuffer(column["doc_ids"][i], "<i8").reshape(2, -1)
        first = column["first"][i]
        for held, doc_id, n in zip(known.tolist(), doc_ids.tolist(), of_block.tolist(), strict=True):
            rows.append((column["file"][i], doc_id if held else None, first, n, zlib.crc32(raw[4 * at : 4 * (at + n)])))
            at += n
            first += n
    yield pa.RecordBatch.from_pylist(
        [dict(zip(("file", "doc_id", "first", "n_tokens", "ids_crc32"), row, strict=True)) for row in rows],
        schema=pa.schema(
            [("file", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
        ),
    )


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files of `folder`."""
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    book = spark.sparkContext.broadcast(read_codebook(spark, folder))
    # One row per file, of which there are at most MAX_FILES.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("file").agg(F.sum("n_ids").alias("n_ids"))
    begins = totals.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("begin"))
    schema = "file int, doc_id long, first long, n_tokens long, ids_crc32 long"
    rows = map_arrow(blocks.drop("block", "n_ids"), _reader(book), schema).join(F.broadcast(begins), "file")
    return rows.select("doc_id", (F.col("begin") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
