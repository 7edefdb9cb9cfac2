"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Merging a pre-token: its bytes form a doubly linked list.  Each adjacent pair
that has a merge rank is put in that rank's bucket, at its left position.  A
bitmap of non-empty buckets, topped by bitmaps of non-empty words, gives the
lowest rank by two find-first-set steps; within a bucket the leftmost
position comes first.  A merge adds the two new pairs; entries whose pair has
changed meanwhile are stale and skipped when met.  Cost is near linear in the
length, however long a pre-token is.

Each distinct run of characters between spaces is merged once a worker while
it stays in a bounded table.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.runs import Recent, worker_tables

#: Entries of the table of encoded runs after a space in a Python worker; that of other runs has a quarter.
CACHE_ENTRIES = 500_000

#: Characters with the property White_Space (fixed values of Unicode).
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: lowest rank first, leftmost first among equals.

    ``buckets`` holds the positions of a rank: one, or a heap of several.
    ``words`` has a 256-bit word of non-empty buckets for each 256 ranks, and
    ``top`` a bit for each non-empty word.
    """
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n))  # of live parts: next part's start; previous part's start
    pair: list[int | None] = [None] * n  # rank of the pair that starts at a position
    buckets: dict[int, int | list[int]] = {}
    words: dict[int, int] = {}
    top, get = 0, ranks.get
    fresh = range(n - 1)
    while True:
        for i in fresh:
            j = after[i]
            pair[i] = rank = get(piece[i : after[j]]) if j < n else None
            if rank is None:
                continue
            if rank not in buckets:
                buckets[rank] = i
                w = rank >> 8
                if w in words:
                    words[w] |= 1 << (rank & 255)
                else:
                    words[w] = 1 << (rank & 255)
                    top |= 1 << w
            elif isinstance(held := buckets[rank], int):
                buckets[rank] = [held, i] if held < i else [i, held]
            else:
                heappush(held, i)
        if not top:
            break
        w = (top & -top).bit_length() - 1  # find first set, twice
        word = words[w]
        rank = w << 8 | (word & -word).bit_length() - 1
        held = buckets[rank]
        i = held if (last := isinstance(held, int)) else heappop(held)
        if last or not held:
            del buckets[rank]
            if word := word & (word - 1):
                words[w] = word
            else:
                del words[w]
                top &= top - 1
        if pair[i] != rank:
            fresh = ()  # stale
            continue
        j = after[i]
        after[i] = k = after[j]
        pair[j] = None
        before[k] = i
        fresh = (i,) if before[i] < 0 else (i, before[i])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Codec:
    """Encodes texts to ids (little-endian unsigned 32-bit) and back."""

    def __init__(self, path: str, pattern: str, entries: int = CACHE_ENTRIES) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.first = Recent(self._split, entries // 4)
        self.spaced = Recent(lambda run: self._split(" " + run), entries)  # runs after one space

    def _split(self, text: str) -> bytes:
        pieces = self.pieces(text)
        if len(pieces) > 1:
            return b"".join([self.spaced[p[1:]] if len(p) > 1 and p[0] == " " and p[1] != " " else self.first[p] for p in pieces])
        ids = merge(text.encode(), self.ranks)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """The pattern takes at most one space into a word, so runs after single
        spaces can be encoded apart, unless white space follows a space."""
        if text.endswith(" ") or any(s in text for s in _AFTER_SPACE):
            return self._split(text)
        first, *rest = text.split(" ")
        return self.first[first] + b"".join(map(self.spaced.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I").tolist()))


_AFTER_SPACE = [" " + s for s in SPACES]


def codec(path: str, pattern: str, entries: int = CACHE_ENTRIES) -> Codec:
    """One codec a Python worker, let go when another operator's tables are made."""
    return worker_tables(("byte_bpe", path, pattern, entries), lambda: Codec(path, pattern, entries))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(id, text) -> id, ids: little-endian unsigned 32-bit ids; a null text is an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["id"], pa.array([c.encode(t or "") for t in b["text"].to_pylist()], pa.binary())], ["id", "ids"])

    return docs.select(F.col("id").cast("long").alias("id"), "text").mapInArrow(run, "id long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(id, ids) -> id, bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["id"], pa.array([c.decode(i or b"") for i in b["ids"].to_pylist()], pa.binary())], ["id", "bytes"])

    return encoded.select(F.col("id").cast("long").alias("id"), "ids").mapInArrow(run, "id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, entries: int = CACHE_ENTRIES) -> DataFrame:
    """(id, text) -> doc_id, n_tokens, ids_sha256, decoded_sha256: encoded, then decoded from the ids alone.

    Both steps run in one pass over each text, so neither ids nor bytes leave
    the task.  Null and empty texts have no ids and the digest of nothing; null
    ids stay null; repeated rows are encoded each; there are no ties.  A text
    is encoded whole, however long.  An empty table gives an empty result.
    Other columns, whatever their names, are left out.  ``entries`` bounds the
    table of encoded runs in a worker (about 0.5 MB a thousand, both halves).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern, entries)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for t in b["text"]:
                ids = c.encode(t.as_py() or "")
                n.append(len(ids) // 4)
                ids_sha.append(sha(ids))
                text_sha.append(sha(c.decode(ids)))
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("id").cast("long").alias("id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
