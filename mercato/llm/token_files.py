"""Token ids in binary files of patched frame-of-reference blocks.

The ids of all documents, in ascending document order, form one stream, cut
into shards (range partitions of the ids) and segments of about
``SEGMENT_IDS`` ids.  A segment is one record: shard, segment, n_ids, the ids
and sizes of its documents, and a payload that can be read by itself:

    magic 4 bytes | ids a block u32 | ids u32 | blocks u32
    start of each block, bytes from the end of this index, u32 each
    blocks: minimum u32 | width u8 | exceptions u16
            | (id - minimum) in ``width`` bits each, low bits first, 0 for an exception
            | exception positions u16 | exception values (id - minimum) u32

``width`` holds the 90th percentile of a block's differences (fewer bits if
that is smaller in total); larger ones are exceptions.  All integers are
little-endian.  The index gives any block of a segment without the others.
"""

from __future__ import annotations

import json
import os
import string
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import materialize
from mercato.llm.runs import Recent, runs
from mercato.llm.token_counts import lowered

MAGIC = b"PFR1"
BLOCK_IDS = 1024
SEGMENT_IDS = 1 << 18
PERCENTILE = 90
HEAD = struct.Struct("<4sIII")
BLOCK = struct.Struct("<IBH")
#: Entries of the table of encoded runs in a Python worker, and the longest run kept.
CACHE_ENTRIES = 1_000_000
CACHE_CHARS = 48
#: Marks that are a piece of their own after letters (all but the apostrophe of contractions).
MARKS = string.punctuation.replace("'", "")


def pack_block(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    over = (ids - low).astype(np.uint32)
    width = int(np.partition(over, k := (len(over) - 1) * PERCENTILE // 100)[k]).bit_length()
    wide = int(over.max()).bit_length()
    if (odd := int((over >> width > 0).sum()) if width < 32 else 0) * 48 >= len(over) * (wide - width):
        width, odd = wide, 0
    at = np.nonzero(over >> width)[0] if odd else np.zeros(0, np.int64)
    values, over = over[at], over.copy()
    over[at] = 0
    bits = np.unpackbits(over.astype("<u4").view(np.uint8), bitorder="little").reshape(-1, 32)[:, :width]
    return (BLOCK.pack(low, width, len(at)) + np.packbits(bits, bitorder="little").tobytes()
            + at.astype("<u2").tobytes() + values.astype("<u4").tobytes())


def unpack_block(data: bytes, at: int, n: int) -> np.ndarray:
    low, width, odd = BLOCK.unpack_from(data, at)
    at += BLOCK.size
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
    wide = np.zeros((n, 16 if width <= 16 else 32), np.uint8)
    wide[:, :width] = bits
    out = np.packbits(wide.ravel(), bitorder="little").view("<u2" if width <= 16 else "<u4").astype(np.uint32)
    at += size
    places = np.frombuffer(data, "<u2", odd, at)
    out[places] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
    return out + np.uint32(low)


def pack(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    """A payload; positions in a block must fit 16 bits."""
    blocks = [pack_block(ids[i : i + block_ids]) for i in range(0, len(ids), block_ids)]
    starts = np.cumsum([0, *map(len, blocks)])[:-1] if blocks else []
    return HEAD.pack(MAGIC, block_ids, len(ids), len(blocks)) + np.asarray(starts, "<u4").tobytes() + b"".join(blocks)


def unpack(payload: bytes, first: int = 0, count: int | None = None) -> np.ndarray:
    """``count`` ids from ``first`` on (all by default); only their blocks are decoded."""
    magic, block_ids, n, blocks = HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a payload of patched frame-of-reference blocks")
    last = n if count is None else min(n, first + count)
    starts = np.frombuffer(payload, "<u4", blocks, HEAD.size)
    area = HEAD.size + 4 * blocks
    chosen = range(first // block_ids, -(-last // block_ids)) if first < last else ()
    parts = [unpack_block(payload, area + int(starts[b]), min(block_ids, n - b * block_ids)) for b in chosen]
    return np.concatenate(parts)[first % block_ids :][: last - first] if parts else np.zeros(0, np.uint32)


def _latin_class(c: str) -> int:
    """Letter 'a', white space ' ', lone mark '.', '0' for what needs the tokenizer's own rules."""
    group = unicodedata.category(c)[0]
    if group == "L":
        return ord("a")
    if c in "\t\n\x0b\x0c\r \x85\xa0":
        return ord(" ")
    return ord(".") if group in "PS" and c != "'" else ord("0")


_LATIN = [chr(i) for i in range(256)]
_CLASS = bytes(map(_latin_class, _LATIN))
_LOWER = "".join(map(str.lower, _LATIN)).encode("latin-1")
_MARKS = [bytes([i]) for i, c in enumerate(_CLASS) if c == ord(".")]
_ASCII_MARKS = [m for m in _MARKS if m.isascii()]


def pieces(text: str) -> list[str]:
    """Parts of a text that are encoded apart and give the text's ids together.

    Runs between white space; or, where a text (else, a line of it) has only
    Latin-1 letters, white space and marks that do not adjoin each other, its
    lower-case words and its marks, of which there are far fewer different ones.
    """
    if (simple := _words_and_marks(text)) is not None:
        return simple
    out = []
    for line in text.split("\n"):
        out += runs(line) if (simple := _words_and_marks(line)) is None else simple
    return out


def _words_and_marks(text: str) -> list[str] | None:
    try:
        data = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    classes = data.translate(_CLASS)
    if b"0" in classes or b".." in classes:
        return None
    data = data.translate(_LOWER)
    if b"." in classes:
        for m in _ASCII_MARKS if data.isascii() else _MARKS:
            if m in data:
                data = data.replace(m, b" " + m + b" ")
    return data.decode("latin-1").split()


class Encoder:
    """The tokenizers library on the runs of a text.

    The tokenizer drops white space and no token spans it, so a text's ids are
    those of its runs one after the other; each distinct run is encoded once
    while it stays in a bounded table.  Letters with marks after them are two
    pieces.  Words of letters are encoded many at a
    time, as one text: a token with the word-end suffix ends a piece, which
    tells where each word's ids end.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            suffix = json.load(f)["model"].get("end_of_word_suffix") or ""
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        self.marks = Recent(lambda marks: self._each([marks])[0], entries=10_000)
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _each(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of each word of letters."""
        out = []
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.nonzero(self.ends[ids])[0] + 1
            if len(ends) != len(part) or ends[-1] != len(ids):  # a word that is more than one piece after all
                out += self._each(part)
                continue
            data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
            out += [data[s:e] for s, e in zip(cuts, cuts[1:], strict=False)]
        return out

    def _make(self, new: list[str]) -> dict[str, bytes]:
        get, made, marked, words, rest = self.old.get, {}, [], {}, []
        for run in new:
            if (ids := get(run)) is not None:
                made[run] = ids
                continue
            word = run.rstrip(MARKS)
            mark = run[len(word):]
            if not word:
                made[run] = self.marks[run]
                continue
            word = word.lower() if word.isascii() else lowered(word)
            if not word.isalpha():  # normalised: some letters are written as a letter and a sign
                rest.append(run)
                continue
            marked.append((run, word, mark))
            if word not in words:
                words[word] = self.known.get(word) or get(word)
        missing = [w for w, ids in words.items() if ids is None]
        words.update(zip(missing, self._words(missing), strict=True))
        for run, word, mark in marked:
            made[run] = words[word] + self.marks[mark] if mark else words[word]
        return made | words | dict(zip(rest, self._each(rest), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        parts = [pieces(t) if t else [] for t in texts]
        if len(self.known) > CACHE_ENTRIES:
            self.old, self.known = self.known, {}
        found = [[*map(self.known.get, p)] for p in parts]
        made = self._make(list({r for p, ids in zip(parts, found, strict=True) if None in ids
                                for r, i in zip(p, ids, strict=True) if i is None}))
        self.known.update((r, ids) for r, ids in made.items() if len(r) <= CACHE_CHARS)
        return [b"".join([made[r] if i is None else i for r, i in zip(p, ids, strict=True)] if None in ids else ids)
                for p, ids in zip(parts, found, strict=True)]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


SEGMENT = "shard int, segment int, n_ids long, doc_ids array<bigint>, doc_sizes array<bigint>, payload binary"


def segments(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """(id, text) -> segments in ascending id order, ``end_id`` after each document."""
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seq, e = TaskContext.get().partitionId(), 0, encoder(path)
        doc_ids, chunks, held = [], [], 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(chunks), "<u4")
            return pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "segment": pa.array([seq], pa.int32()), "n_ids": pa.array([len(ids)], pa.int64()),
                 "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())), "doc_sizes": pa.array([[len(c) // 4 for c in chunks]], pa.list_(pa.int64())),
                 "payload": pa.array([pack(ids)], pa.binary())})

        for b in batches:
            for doc, ids in zip(b["id"].to_pylist(), e.encode(b["text"].to_pylist()), strict=True):
                doc_ids.append(doc)
                chunks.append(ids + end)
                held += len(chunks[-1]) // 4
                if held >= SEGMENT_IDS:
                    yield segment()
                    doc_ids, chunks, held, seq = [], [], 0, seq + 1
        if chunks:
            yield segment()

    ordered = (docs.select(F.col("id").cast("long").alias("id"), "text").withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text"))
    return ordered.mapInArrow(run, SEGMENT)


def read(stored: DataFrame) -> DataFrame:
    """Segments -> doc_id, start, n_tokens, ids_crc32, from the stored bytes.

    A segment's start is the sum of the sizes of the shards before it (one row
    a shard) and of the segments before it in its shard.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = unpack(r["payload"]).astype("<u4")
                ends = np.cumsum(r["doc_sizes"], dtype=np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                yield pa.RecordBatch.from_pydict(
                    {"shard": pa.array([r["shard"]] * len(ends), pa.int32()), "segment": pa.array([r["segment"]] * len(ends), pa.int32()),
                     "doc_id": pa.array(r["doc_ids"], pa.int64()), "local": starts, "n_tokens": ends - starts,
                     "ids_crc32": pa.array([zlib.crc32(ids[s:t].tobytes()) for s, t in zip(starts, ends, strict=True)], pa.int64())})

    rows = stored.select("shard", "segment", "doc_ids", "doc_sizes", "payload").mapInArrow(
        run, "shard int, segment int, doc_id long, local long, n_tokens long, ids_crc32 long")
    sizes = stored.select("shard", "segment", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.join(shards, "shard").select(
        "shard", "segment", (F.col("base") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("base"))
    return rows.join(bases, ["shard", "segment"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """(id, text) -> doc_id, start, n_tokens, ids_crc32, read back from the written files.

    Null and empty texts have the end id alone.  A null id comes before all
    others; repeated ids stand one after another, in order of their texts'
    hashes.  Texts are encoded whole, however long.  An empty table gives an
    empty file set and result.  Other columns, whatever their names, are left out.
    """
    return read(materialize(segments(docs, path, end_id), "token-files"))
