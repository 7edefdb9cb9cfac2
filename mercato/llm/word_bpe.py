"""BPE encoding and decoding that speculates and verifies.

The tokenizer (NFC, lower case, pieces of letters / one number / other
characters / contractions, byte-level BPE whose last symbol of a piece carries
a word end) is followed in three steps.

Speculate: each new piece is cut greedily into the longest vocabulary entries.

Verify: a sequence of tokens is the piece's encoding exactly if each token is
what merging its own symbols gives, and no two neighbours would have been
merged across their boundary.  The second is tested for all neighbours of all
pieces of a batch at once: arrays of (left, right) tokens are walked back in
time, the later made one of a pair being undone in each step; a pair fails if
the parts that meet at the boundary have a merge that comes before the undone
one.  Merges come in the order of their ranks, because a merge that needs a
token always has a higher rank than the one that makes it (tested when the
vocabulary is read).

Repair: pieces with a failing pair, and only those, are merged exactly, from a
heap of ranks over a linked list of symbols.

Each distinct run of characters between white space is encoded once a worker
while it stays in a table that is bounded in bytes.  Runs beyond Latin-1 are
normalised and cut by the library itself, so that no other Unicode tables
decide about them.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.runs import Held, runs, worker_tables

#: Bytes of the tables of encoded runs and of encoded pieces in a Python worker.
RUN_BYTES, PIECE_BYTES = 160_000_000, 120_000_000

#: The tokenizer's pieces (fixed value).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

NEVER = 1 << 40


def letters_of_bytes() -> str:
    """For each byte the character that byte-level vocabularies write: itself if printable, else the next from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in printable]
    return "".join(chr(b if b in printable else 0x100 + hidden.index(b)) for b in range(256))


class Merges:
    """Vocabulary and merges, as dicts and as arrays over token ids."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str) -> None:
        self.ids, self.end = vocab, end
        self.size = max(vocab.values()) + 1
        self.longest = max(len(t.removesuffix(end)) for t in vocab)
        self.reach: dict[str, int] = {}  # of two letters, the longest token that begins with them and ends no piece
        for t in vocab:
            if len(t) > 1 and not t.endswith(end):
                self.reach[t[:2]] = max(self.reach.get(t[:2], 1), len(t))
        self.made = np.full(self.size, -1, np.int64)  # rank of the merge that makes a token; -1: a single symbol
        self.left, self.right = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        self.rank: dict[int, int] = {}  # of a pair, by left * size + right
        self.result: list[int] = []
        for r, (a, b) in enumerate(merges):
            x, y, t = vocab[a], vocab[b], vocab[a + b]
            if self.made[t] >= 0:
                raise ValueError(f"merge {r} makes a token that is made already")
            self.made[t], self.left[t], self.right[t] = r, x, y
            self.rank[x * self.size + y] = r
            self.result.append(t)
        made = np.nonzero(self.made >= 0)[0]
        if (np.maximum(self.made[self.left[made]], self.made[self.right[made]]) >= self.made[made]).any():
            raise ValueError("a merge needs a token that is made later")
        self.keys = np.array(sorted(self.rank), np.int64)
        self.key_ranks = np.array([self.rank[k] for k in self.keys.tolist()], np.int64)

    def ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        key = x * self.size + y
        if not len(self.keys):
            return np.full(len(key), NEVER)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], NEVER)

    def compatible(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray | int = NEVER) -> np.ndarray:
        """Whether no merge before ``limit`` crosses from token x into its right neighbour y."""
        good, live = np.ones(len(x), bool), np.arange(len(x))
        limit = np.full(len(x), limit, np.int64) if np.isscalar(limit) else limit
        while len(live):
            crossing = self.ranks(x, y) < limit
            good[live[crossing]] = False
            mx, my = self.made[x], self.made[y]
            on = ~crossing & (np.maximum(mx, my) >= 0)
            x, y, mx, my, live = x[on], y[on], mx[on], my[on], live[on]
            undo_x = mx > my  # of equal merges the left one came first, so y is undone first
            limit = np.where(undo_x, mx, my + 1)  # a merge at y's own rank would have come before, being further left
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return good

    @cached_property
    def stable(self) -> np.ndarray:
        """Of each token whether merging its symbols gives that token."""
        good = np.ones(self.size, bool)
        made = np.nonzero(self.made >= 0)[0]
        made = made[np.argsort(self.made[made])]
        met = self.compatible(self.left[made], self.right[made], self.made[made])
        for t, ok, a, b in zip(made.tolist(), met.tolist(), self.left[made].tolist(), self.right[made].tolist(), strict=True):
            good[t] = ok and good[a] and good[b]
        return good

    def propose(self, piece: str) -> list[int]:
        """Greedy longest match."""
        ids, get, reach, i, n = [], self.ids.get, self.reach.get, 0, len(piece)
        while True:
            rest = n - i
            if rest <= self.longest and (t := get(piece[i:] + self.end)) is not None:
                ids.append(t)
                return ids
            for size in range(min(reach(piece[i : i + 2], 1), rest - 1), 0, -1):
                if (t := get(piece[i : i + size])) is not None:
                    break
            else:
                raise ValueError(f"the vocabulary lacks the symbol {piece[i]!r}")
            ids.append(t)
            i += size

    def exact(self, piece: str) -> list[int]:
        """Merges lowest rank first, leftmost first among equals."""
        tokens = [self.ids[c] for c in piece[:-1]] + [self.ids[piece[-1] + self.end]]
        n, size, get = len(tokens), self.size, self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [r * n + i for i in range(n - 1) if (r := get(tokens[i] * size + tokens[i + 1])) is not None]
        heapify(heap)
        while heap:
            r, i = divmod(heappop(heap), n)
            if (j := after[i]) >= n or tokens[i] < 0 or get(tokens[i] * size + tokens[j]) != r:
                continue  # one of the two has been merged meanwhile
            tokens[i], tokens[j] = self.result[r], -1
            after[i] = k = after[j]
            before[k] = i
            if k < n and (r := get(tokens[i] * size + tokens[k])) is not None:
                heappush(heap, r * n + i)
            if (h := before[i]) >= 0 and (r := get(tokens[h] * size + tokens[i])) is not None:
                heappush(heap, r * n + h)
        return [t for t in tokens if t >= 0]

    def encode(self, pieces: list[str]) -> list[list[int]]:
        """Tokens of each piece (written in byte letters, not empty)."""
        out = [*map(self.propose, pieces)]
        if not out:
            return out
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter(chain.from_iterable(out), np.int64, int(sizes.sum()))
        word = np.repeat(np.arange(len(out)), sizes)
        inside = np.nonzero(word[1:] == word[:-1])[0]
        pairs, which = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failing = np.union1d(word[inside[~good[which]]], word[~self.stable[flat]])
        for w in failing.tolist():
            out[w] = self.exact(pieces[w])
        return out


class Codec:
    """Encodes texts to ids (little-endian unsigned 32-bit) and back."""

    def __init__(self, path: str, run_bytes: int = RUN_BYTES, piece_bytes: int = PIECE_BYTES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.merges = Merges(model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]],
                             model["end_of_word_suffix"])
        library = Tokenizer.from_file(path)
        self.normalize, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.specials = {t["content"]: struct.pack("<I", t["id"]) for t in spec["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")").split if self.specials else None
        self.names = [b""] * (1 + max([self.merges.size - 1, *(t["id"] for t in spec["added_tokens"])]))
        for token, i in [*model["vocab"].items(), *((t["content"], t["id"]) for t in spec["added_tokens"])]:
            self.names[i] = token.encode()
        self.letters = letters_of_bytes()
        self.latin = regex.compile(PIECES).findall
        self.runs, self.pieces = Held(run_bytes), Held(piece_bytes)

    def pieces_of(self, run: str) -> list[str]:
        """The pieces of a run between white space, in byte letters."""
        try:
            run.encode("latin-1")
        except UnicodeEncodeError:
            return [p for p, _ in self.cut(self.normalize(run))]
        run = run.lower()
        if run.isascii() and run.isprintable():
            return self.latin(run)
        return [p.encode().decode("latin-1").translate(self.letters) for p in self.latin(run)]

    def _make(self, new: list[str]) -> dict[str, bytes]:
        cut = [*map(self.pieces_of, new)]
        known, missing = self.pieces.find(set(chain.from_iterable(cut)))
        for p, ids in zip(missing, self.merges.encode(missing), strict=True):
            known[p] = struct.pack(f"<{len(ids)}I", *ids)
        self.pieces.add({p: known[p] for p in missing})
        return {r: b"".join(map(known.__getitem__, c)) for r, c in zip(new, cut, strict=True)}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        segments = [[t] if t and ("<" not in t or not self.special) else self.special(t) if t else [] for t in texts]
        cut = [[r for i, s in enumerate(parts) for r in ((s,) if i % 2 else runs(s))] if len(parts) > 1 else runs(parts[0]) if parts else []
               for parts in segments]
        wanted = set().union(*cut)
        known, missing = self.runs.find(wanted - self.specials.keys())
        made = self._make(missing)
        self.runs.add(made)
        known.update(made)
        known.update((s, ids) for s, ids in self.specials.items() if s in wanted)
        return [b"".join(map(known.__getitem__, c)) for c in cut]

    def decode(self, ids: bytes) -> bytes:
        """As the library without a decoder: tokens as the vocabulary writes them, joined by spaces."""
        return b" ".join(map(self.names.__getitem__, memoryview(ids).cast("I")))


def codec(path: str) -> Codec:
    """One codec a Python worker, while no other operator's tables take its place."""
    return worker_tables(("word_bpe", path), lambda: Codec(path))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(id, text) -> id, ids: little-endian unsigned 32-bit ids; a null text is an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(c.encode(b["text"].to_pylist()), pa.binary())], ["id", "ids"])

    return docs.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(id, ids) -> id, text; null ids are none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            texts = [c.decode(i or b"").decode() for i in b["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(texts, pa.string())], ["id", "text"])

    return encoded.select(F.col("id").cast("long").alias("id"), "ids").mapInArrow(run, "id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(id, text) -> doc_id, n_tokens, ids_sha256, decoded_sha256: encoded, then decoded from the ids alone.

    Both steps run in one pass over each text, so neither ids nor texts leave
    the task.  Null and empty texts, and texts of white space, have no ids and
    the digest of nothing.  Null ids stay null; repeated rows are encoded each;
    there are no ties.  A text is encoded whole, however long; a run without
    spaces costs n log n at most.  An empty table gives an empty result.  Other
    columns, whatever their names, are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            ids = c.encode(b["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b["id"], pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                 pa.array([hashlib.sha256(c.decode(i)).hexdigest() for i in ids], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
