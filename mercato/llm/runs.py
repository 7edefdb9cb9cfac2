"""Texts as runs between white space, and a bounded table of what runs map to."""

from __future__ import annotations

from collections.abc import Callable

import regex

_SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space for str.split, but not by the property White_Space
_split = regex.compile(r"\p{White_Space}+").split


def runs(text: str) -> list[str]:
    """The runs of a text between characters with the property White_Space."""
    if any(c in text for c in _SEPARATORS):
        return [r for r in _split(text) if r]
    return text.split()


class Recent(dict):
    """run -> make(run), kept for at least the last ``entries`` runs that were made.

    When full, the table becomes the old one, from which runs that are met
    again are taken over, and the older one is let go.  Runs longer than
    ``longest`` are made anew each time.  ``longest`` also bounds the bytes:
    an entry takes 230 or so beside what the value holds.
    """

    def __init__(self, make: Callable, entries: int = 450_000, longest: int = 48) -> None:
        super().__init__()
        self.make, self.entries, self.longest, self.old = make, entries, longest, {}

    def __missing__(self, run: str):
        out = self.old.get(run)
        if out is None:
            out = self.make(run)
        if len(run) <= self.longest:
            if len(self) >= self.entries:
                self.old = None  # gone before its successor is copied
                self.old = dict(self)
                self.clear()
            self[run] = out
        return out


class Held:
    """run -> bytes, bounded by the bytes that keys, values and their entries take.

    When half of them are used, the entries become the older half, from which
    runs that are met again are taken over, and the half before is let go.
    """

    ENTRY = 190  # bytes of an entry beside its characters: two objects' heads, and a place in a dict
    LONGEST = 200  # characters of a run that is kept

    def __init__(self, limit: int) -> None:
        self.limit, self.used = limit, 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def find(self, runs: set[str]) -> tuple[dict[str, bytes], list[str]]:
        """What is held of these runs, and the others."""
        known, again, missing, new, old = {}, {}, [], self.new.get, self.old.get
        for r in runs:
            if (v := new(r)) is not None:
                known[r] = v
            elif (v := old(r)) is not None:
                known[r] = again[r] = v
            else:
                missing.append(r)
        self.add(again)
        return known, missing

    def add(self, made: dict[str, bytes]) -> None:
        for r, v in made.items():
            if len(r) > self.LONGEST:
                continue
            if self.used >= self.limit // 2:
                self.old, self.new, self.used = self.new, {}, 0
            self.new[r] = v
            self.used += self.ENTRY + len(r) * (1 if r.isascii() else 2) + len(v)


_tables: dict = {}


def worker_tables(key: tuple, make: Callable):
    """The tables that ``make`` gives, one set a Python worker: workers serve
    one operator after another, and what an earlier one held is let go."""
    if key not in _tables:
        _tables.clear()
        _tables[key] = make()
    return _tables[key]
