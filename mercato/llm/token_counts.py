"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

The tokenizer (lower case, NFC, pieces of letters / one digit / other
characters / contractions, byte-level BPE whose last symbol of a piece carries
a word end) is compiled to a deterministic transducer over characters.  A
transition is annotated with the number of tokens that it emits, that is,
tokens that no continuation can change.

BPE from left to right: the encoding of a prefix without its last token is the
encoding of the shorter prefix, and a token may follow another one exactly if
merging both together gives the two again.  So the last token of each prefix
is the only vocabulary entry that ends there and may follow the last token of
the prefix before it.  A state is the set of open starts: the symbols since a
start, the token before it and its count relative to the lowest one; the
lowest count is what a transition emits.  Starts that no vocabulary entry
continues are dropped, so there are finitely many states; they are built when
first reached and rebuilt if a bounded table of them is emptied.

A long text is cut into chunks.  What a chunk does to any entry state is its
state map: white space leads every state back to the start, so a map is the
part before the first white space, to be run from the entry state, and then a
fixed count and exit state.  Maps compose associatively, and a chunk's map
needs no other chunk; the maps of a text are composed pairwise in a scan of
logarithmic depth.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.runs import Recent, runs

#: States of the transducer kept in a Python worker, and characters in a chunk of a long text.
MAX_STATES = 350_000
CHUNK_CHARS = 4096

#: Contractions that are pieces of their own, without the apostrophe (fixed values of the tokenizer).
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

_space = regex.compile(r"\p{White_Space}").match


def byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Bpe:
    """Vocabulary and merges; merges short symbol sequences, to compile from."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab = set(model["vocab"])
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {p: i for i, p in enumerate(pairs)}
        self.specials = [t["content"] for t in spec["added_tokens"]]
        bare = {t.removesuffix(self.end) for t in self.vocab}
        self.prefixes = {t[:n] for t in bare for n in range(1, len(t))}
        self.letters = byte_letters()

    def symbols(self, token: str) -> list[str]:
        bare = token.removesuffix(self.end)
        out = list(bare)
        if bare != token:
            out[-1] += self.end
        return out

    def merged(self, parts: list[str]) -> list[str]:
        while len(parts) > 1:
            best = min(((self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False))))
            if best[0] == 1 << 60:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    @lru_cache(maxsize=200_000)  # noqa: B019  one vocabulary a worker
    def follows(self, before: str, token: str) -> bool:
        """Whether ``token`` may stand after ``before`` ('' at a piece's start) in an encoding."""
        together = self.symbols(before) + self.symbols(token) if before else self.symbols(token)
        return self.merged(together) == ([before, token] if before else [token])


Open = tuple[tuple[str, str, int], ...]  # of each open start: symbols since, token before, count above the lowest
AT_START: Open = (("", "", 0),)


class State(dict):
    """character -> (next state, tokens emitted); made when missing."""

    __slots__ = ("kind", "machine", "opened", "pending", "rest")

    def __init__(self, machine: Machine, kind: str, opened: Open, pending: str) -> None:
        super().__init__()
        self.machine, self.kind, self.opened, self.pending = machine, kind, opened, pending
        self.rest = -1

    def __missing__(self, char: str) -> tuple[State, int]:
        out = self[char] = self.machine.transition(self, char)
        return out

    def end(self) -> int:
        """Tokens still to come if the piece ends here."""
        if self.rest < 0:
            self.rest = self.machine.finish(self)
        return self.rest


class Machine:
    """The transducer.  Kinds of state: '' between pieces, L in letters, O in
    other characters, and an apostrophe with what may become a contraction."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.bpe = Bpe(path)
        library = Tokenizer.from_file(path)
        self.normalize, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.groups: dict[str, str] = {}  # character -> L, N or O
        self.states: dict[tuple[str, Open, str], State] = {}
        self.shared: dict[tuple[str, str, int], tuple[str, str, int]] = {}  # one copy of each open start
        self.start = State(self, "", (), "")
        self.counts = Recent(self.run, entries=700_000)
        self.specials = regex.compile("|".join(map(regex.escape, self.bpe.specials))).split

    def run(self, chars: str) -> int:
        """Tokens of a run between white space."""
        s, n = self.walk(self.start, chars)
        return n + s.end()

    def state(self, kind: str, opened: Open, pending: str) -> State:
        key = (kind, opened, pending)
        if (s := self.states.get(key)) is None:
            if len(self.states) >= MAX_STATES:
                for old in (self.start, *self.states.values()):
                    old.clear()
                self.states.clear()
                self.shared.clear()
            s = self.states[key] = State(self, kind, opened, pending)
        return s

    def advance(self, opened: Open, symbol: str) -> tuple[Open, int]:
        """One symbol that does not end the piece."""
        bpe, longer, last = self.bpe, [], None
        for since, before, count in opened:
            token = since + symbol
            if token in bpe.vocab and last is None and bpe.follows(before, token):
                last = ("", token, count + 1)
            if token in bpe.prefixes:
                longer.append((token, before, count))
        longer.append(last)
        low = min(count for _, _, count in longer)
        return tuple(self.shared.setdefault(x, x) for x in ((a, b, count - low) for a, b, count in longer)), low

    def add(self, kind: str, opened: Open, pending: str, char: str) -> tuple[State, int]:
        """A character of the current piece; its last byte stays pending, as it may be the piece's last."""
        emitted = 0
        for byte in char.encode():
            if pending:
                opened, low = self.advance(opened, pending)
                emitted += low
            pending = self.bpe.letters[byte]
        return self.state(kind, opened, pending), emitted

    def finish(self, state: State) -> int:
        if not state.pending:
            return 0
        if len(state.kind) > 1:  # an apostrophe and letters that became no contraction
            return self.piece("'") + self.counts[state.kind[1:]]
        for since, before, count in state.opened:
            token = since + state.pending + self.bpe.end
            if token in self.bpe.vocab and self.bpe.follows(before, token):
                return count + 1
        raise ValueError(f"no token ends with {state.pending!r}: the vocabulary lacks single bytes")

    def group(self, char: str) -> str:
        """Letter, number or other, as the library's own tables have it: asked once a character."""
        if (g := self.groups.get(char)) is None:
            g = "L" if len(self.cut("a" + char)) == 1 else "O" if len(self.cut("!" + char)) == 1 else "N"
            self.groups[char] = g
        return g

    def normalized(self, text: str) -> str:
        """NFC and lower case: by Python for Latin-1, which has settled tables, else by the library."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.normalize(text)
        return lowered(text)

    def transition(self, state: State, char: str) -> tuple[State, int]:
        kind = state.kind
        if _space(char):
            return self.start, state.end()
        if kind.startswith("'"):
            tail = kind[1:] + char
            if tail in CONTRACTIONS:
                return self.start, self.piece("'" + tail)
            if any(c.startswith(tail) for c in CONTRACTIONS):
                return self.state("'" + tail, state.opened, state.pending), 0
            if kind != "'":  # the apostrophe was a piece; the letters after it begin another
                s, n = self.walk(self.start, kind[1:] + char)
                return s, n + self.piece("'")
        if (group := self.group(char)) == "L":
            if kind == "L":
                return self.add("L", state.opened, state.pending, char)
            s, n = self.add("L", AT_START, "", char)
        elif group == "N":
            s, n = self.start, self.piece(char)
        elif kind and kind[0] in "O'":
            return self.add("O", state.opened, state.pending, char)
        else:
            s, n = self.add("'" if char == "'" else "O", AT_START, "", char)
        return s, n + state.end()

    def piece(self, chars: str) -> int:
        """Tokens of a whole piece."""
        opened, pending, n = AT_START, "", 0
        for c in chars:
            s, low = self.add("O", opened, pending, c)
            opened, pending, n = s.opened, s.pending, n + low
        return n + s.end()

    def walk(self, state: State, chars: str) -> tuple[State, int]:
        n = 0
        for c in chars:
            state, emitted = state[c]
            n += emitted
        return state, n

    def count(self, text: str) -> int:
        """Tokens of a whole text; strings of added tokens inside it count one each."""
        segments = self.specials(text) if "<" in text else [text]
        return len(segments) - 1 + sum(map(self.segment, segments))

    def segment(self, text: str) -> int:
        text = self.normalized(text)
        if len(text) <= CHUNK_CHARS:
            return sum(map(self.counts.__getitem__, runs(text)))
        maps = [self.chunk_map(text[i : i + CHUNK_CHARS]) for i in range(0, len(text), CHUNK_CHARS)]
        while len(maps) > 1:  # an up-sweep: neighbours compose
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        exit_, n = self.apply(maps[0], self.start)
        return n + exit_.end()

    def chunk_map(self, chunk: str) -> ChunkMap:
        words = runs(chunk)
        if not words:
            return ChunkMap("", True, 0, self.start)
        head = "" if _space(chunk[0]) else words[0]
        if head == chunk:
            return ChunkMap(chunk, False, 0, self.start)
        tail = "" if _space(chunk[-1]) else words[-1]
        inner = words[bool(head) : len(words) - bool(tail)]
        exit_, n = self.walk(self.start, tail)
        return ChunkMap(head, True, n + sum(map(self.counts.__getitem__, inner)), exit_)

    def apply(self, m: ChunkMap, entry: State) -> tuple[State, int]:
        s, n = self.walk(entry, m.head)
        return (m.exit, n + s.end() + m.count) if m.spaced else (s, n)

    def compose(self, f: ChunkMap, g: ChunkMap) -> ChunkMap:
        """The map of f's chunk and then g's."""
        if not f.spaced:
            return g._replace(head=f.head + g.head)
        exit_, n = self.apply(g, f.exit)
        return f._replace(count=f.count + n, exit=exit_)


class ChunkMap(NamedTuple):
    """Entry state -> exit state and count: run ``head``; if ``spaced``, white
    space follows and from there on ``count`` and ``exit`` are fixed."""

    head: str
    spaced: bool
    count: int
    exit: State


def lowered(text: str) -> str:
    """NFC, then each character's own lower case (no rule for a final sigma)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@lru_cache(maxsize=1)
def machine(path: str) -> Machine:
    """One transducer a Python worker."""
    return Machine(path)


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """(id, text) -> doc_id, n_bytes, n_tokens, over_limit; one row a document.

    A null or empty text has 0 bytes and 0 tokens.  Null ids stay null;
    repeated rows are counted each; there are no ties.  Texts are counted
    whole, long ones in chunks whose maps are composed.  An empty table gives
    an empty result.  Other columns, whatever their names, are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = machine(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["id"], b["n_bytes"], pa.array([m.count(t) for t in b["text"].to_pylist()], pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce("text", F.lit(""))
    return (docs.select(F.col("id").cast("long").alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
            .mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
