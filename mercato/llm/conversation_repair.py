"""Conversation structure repair by an auction shortest-path algorithm.

A conversation's rows, each kept, given another role, or deleted, with turns
inserted anywhere, must give roles ``(s?(ua)+)?``.  The lattice has a node for
each number of rows taken and each of four places in that pattern; its arcs are
edits with whole costs.  The auction keeps a price a node, never above what an
arc costs plus the price at its end.  A path starts at a node and grows at its
end: where the end's price is below the best arc, the price rises to it and the
path contracts; else it extends along that arc.  A path is done when it meets a
node whose price has converged, and then all of its nodes have.  Origins are
taken from the last layer back to the first, so each path is short, and in the
end every price is the least cost to the goal.  The arcs whose cost is the
difference of two prices (tight arcs) are those of cheapest edits; from the
first node they are followed by the least initial.

The lattice depends only on a class of each row (initial of its role, must be
deleted or not, truncated or not), one byte a row.  Spark damages, flags and
classes the rows, deals them by conversation and sorts them; Python tasks read
them in order and never hold a conversation's texts: the first pass holds the
classes and the edits (a byte a row, as long as the audit that is returned),
with prices of one block of rows at a time, and the second one feeds the
repaired text to a digest row by row.  That digest is one sequence over all of
a conversation's text, so one task reads it, however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import materialize

KEEP, ROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
EMPTY, SYSTEM, OPEN, PAIR = range(4)  # places: nothing yet, after s, after u (a must follow), after u a
GOALS = (EMPTY, PAIR)
BLOCK = 4096

#: Row class: initial of the role (0 other, 1 s, 2 u, 3 a) + 4 if it must be deleted + 8 if truncated.
INITIALS = {"s": 1, "u": 2, "a": 3}

_INSERT = {EMPTY: OPEN, SYSTEM: OPEN, OPEN: PAIR, PAIR: OPEN}


def row_arcs(cls: int) -> list[list[tuple[str, int, int]]]:
    """For each place the edits of a row in ASCII order: initial, cost, place after it."""
    initial, blocked, extra = cls & 3, cls & 4, TRUNCATED if cls & 8 else 0
    out = []
    for place in range(4):
        arcs = [("D", DELETE, place)]
        if not blocked:
            if initial == 1 and place == EMPTY:
                arcs.append(("K", KEEP + extra, SYSTEM))
            if initial == (3 if place == OPEN else 2):
                arcs.append(("K", KEEP + extra, _INSERT[place]))
            arcs.append(("R", ROLE + extra, _INSERT[place]))
        out.append(arcs)
    return out


ROW_ARCS = [row_arcs(c) for c in range(16)]


def auction_layer(arcs: list[list[tuple[str, int, int]]] | None, later: list[int] | None) -> list[int]:
    """Converged prices of one layer, given those of the next one (None: the last layer)."""
    price, settled = [0] * 4, [later is None and place in GOALS for place in range(4)]  # a goal's price is 0
    for origin in range(4):
        path = [origin]
        while not settled[end := path[-1]]:
            least, to = price[_INSERT[end]] + INSERT, _INSERT[end]
            if arcs:
                for _, cost, place in arcs[end]:
                    if cost + later[place] <= least:
                        least, to = cost + later[place], None  # the next layer's prices have converged
            if price[end] < least:
                price[end] = least  # contract
                if len(path) > 1:
                    path.pop()
            elif to is None:
                break
            else:
                path.append(to)  # extend
        for place in path:
            settled[place] = True
    return price


def solve(classes: bytes) -> tuple[int, str]:
    """Least cost, and the initials of the ASCII-least cheapest edits."""
    n = len(classes)
    starts = range(0, n, BLOCK)
    price = auction_layer(None, None)
    ends = []  # prices after each block, last block first

    def layers(start: int, price: list[int]) -> list[list[int]]:
        """Prices of a block's layers, in order, the one after its last row included."""
        out = [price]
        for c in reversed(classes[start : start + BLOCK]):
            out.append(auction_layer(ROW_ARCS[c], out[-1]))
        return out[::-1]

    held = [price]
    for start in reversed(starts):
        ends.append(price)
        held = layers(start, price)
        price = held[0]
    cost, place, audit = price[EMPTY], EMPTY, []
    for start in starts:
        if start:
            held = layers(start, ends[-1 - start // BLOCK])
        for c, here, there in zip(classes[start : start + BLOCK], held, held[1:], strict=False):
            place = _row(c, place, here, there, audit)
    while place not in GOALS:
        place = _INSERT[place]
        audit.append("I")
    return cost, "".join(audit)


def _row(c: int, place: int, here: list[int], there: list[int], audit: list[str]) -> int:
    """Follows tight arcs of a layer until a row is taken: D before I before K before R."""
    while True:
        tight = {edit: to for edit, cost, to in ROW_ARCS[c][place] if here[place] == cost + there[to]}
        if "D" not in tight and here[place] == INSERT + here[_INSERT[place]]:
            audit.append("I")
            place = _INSERT[place]
            continue
        edit = min(tight)
        audit.append(edit)
        return tight[edit]


solve_known = lru_cache(maxsize=50_000)(solve)  # for short conversations: most are alike


class Edited:
    """Lines ``role:text`` of an edited conversation; roles follow from the pattern."""

    def __init__(self, audit: str) -> None:
        self.edits, self.at, self.place = audit, 0, EMPTY

    def _role(self) -> str:
        role, self.place = "assistant" if self.place == OPEN else "user", _INSERT[self.place]
        return role

    def inserted(self) -> list[str]:
        """The turns inserted before the next row, or at the end."""
        start = self.at
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
        return [self._role() + ":" for _ in range(self.at - start)]

    def row(self, role: str, text: str) -> list[str]:
        lines = self.inserted()
        edit, self.at = self.edits[self.at], self.at + 1
        if edit == "K" and self.place == EMPTY and role.startswith("s"):
            self.place = SYSTEM
            lines.append(f"{role}:{text}")
        elif edit != "D":
            new = self._role()
            lines.append(f"{role if edit == 'K' else new}:{text}")
        return lines


def damaged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text) with the damage that a checksum of conversation and turn deals out.

    Of 20 cases: 0 drops the row (it stays, marked, without role and text), 1
    empties its text, 2 takes ``. ! ?`` out of it, 3 gives it twice, 4 makes its
    role user.  Null conversations and turns are one space in the checksum's text.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(part("conv"), F.lit(":"), part("turn")).cast("binary")) % 20
    stays = F.col("case") != 0
    return (rows.withColumn("case", case)
            .select("conv", "turn", F.when(F.col("case") == 4, "user").when(stays, F.col("role")).alias("role"),
                    F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate("text", ".!?", "")).when(stays, F.col("text")).alias("text"),
                    (~stays).alias("dropped"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("case") == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


STATS = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _conversation(conv: int | None, turns: tuple, counts: list[int], classes: bytearray) -> tuple:
    low, high, distinct = turns
    cost, audit = solve_known(bytes(classes)) if len(classes) <= 64 else solve(bytes(classes))
    return (conv, high - low + 1 - distinct if distinct else 0, *counts, cost, audit)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of rows in order -> one row a conversation."""
    names = [c.split()[0] for c in STATS.split(", ")]
    types = [pa.string() if c.endswith("string") else pa.int64() for c in STATS.split(", ")]
    out: list[tuple] = []
    begun, conv, size = False, None, 0

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    for b in batches:
        for c, turn, cls, fault in zip(*(b[n].to_pylist() for n in ("conv", "turn", "cls", "fault")), strict=True):
            if not begun or c != conv:
                if begun:
                    out.append(_conversation(conv, (low, high, distinct), counts, classes))
                    size += len(classes)
                    if size > 1_000_000:
                        yield flushed()
                        out, size = [], 0
                begun, conv, classes, counts = True, c, bytearray(), [0, 0, 0, 0]
                low = high = last = None
                distinct, before = 0, -1
            if cls is None:  # a dropped row
                continue
            if turn is not None and turn != last:
                low, high, last, distinct = turn if low is None else low, turn, turn, distinct + 1
            if fault:
                counts[fault - 1] += 1
            if before >= 0 and (before, cls & 3) not in ((1, 2), (2, 3), (3, 2)):
                counts[3] += 1
            before = cls & 3
            classes.append(cls)
    if begun:
        out.append(_conversation(conv, (low, high, distinct), counts, classes))
        yield flushed()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation its row of statistics and then its rows in order -> statistics with the digest."""
    names = [c.split()[0] for c in STATS.split(", ")]
    types = [pa.string() if c.endswith("string") else pa.int64() for c in STATS.split(", ")]
    stats, digest, edited, begun, out = None, None, None, False, []

    def feed(lines: list[str]) -> None:
        nonlocal begun
        for line in lines:
            digest.update(("\n" + line if begun else line).encode())
            begun = True

    def closed() -> tuple:
        feed(edited.inserted())
        return (*stats, digest.hexdigest())

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [*types, pa.string()], strict=True)], [*names, "repaired_sha256"])

    for b in batches:
        heads = zip(*(b[n].to_pylist() for n in names), strict=True)
        for is_row, role, text, head in zip(*(b[n].to_pylist() for n in ("is_row", "role", "text")), heads, strict=True):
            if is_row:
                feed(edited.row(role, text))
                continue
            if stats is not None:
                out.append(closed())
            stats, digest, edited, begun = head, hashlib.sha256(), Edited(head[-1]), False
        if out:
            yield flushed()
            out = []
    if stats is not None:
        out.append(closed())
        yield flushed()


def repair(conversations: DataFrame, damage: bool = True) -> DataFrame:
    """(conv, turn, role, text) -> one row for each conversation: conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, null turns first; rows of one turn in the order of
    a digest of role and text, so ties are told apart unless the rows are the
    same.  A repeated row is a duplicate.  Null roles and texts are one space
    (a text of one space is blank).  Null conversations are one conversation.
    Texts are read whole, however long, one row at a time.  A conversation
    whose rows are all dropped has zeros, an empty audit and the digest of
    nothing; an empty table gives an empty result.  Other columns, whatever
    their names, are left out.  Turns must span less than a long.
    """
    given = conversations.select(F.col("conv").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                                 *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = damaged(given) if damage else given.withColumn("dropped", F.lit(False))
    rows = rows.withColumns({"h": F.xxhash64("role", "text"), "h2": F.xxhash64("text", "role", F.lit(1))})
    by_turn = [F.col("turn").asc_nulls_first(), "h", "h2"]

    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    initial = F.substring("role", 1, 1)
    seen = Window.partitionBy("conv", "dropped", "h", "h2").orderBy(by_turn[0])
    light = rows.select("conv", "turn", "dropped", "h", "h2", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"),
                        F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0).alias("initial"))
    flagged = (light.repartition("conv").withColumn("again", F.row_number().over(seen) > 1)
               .withColumn("fault", F.expr("CASE WHEN blank THEN 1 WHEN again THEN 2 WHEN cut THEN 3 ELSE 0 END"))
               .withColumn("cls", F.expr("CASE WHEN NOT dropped THEN initial + CASE fault WHEN 0 THEN 0 WHEN 3 THEN 8 ELSE 4 END END")))
    ordered = flagged.sortWithinPartitions("conv", *by_turn, "again").select("conv", "turn", "cls", "fault")
    audits = materialize(ordered.mapInArrow(_audits, STATS), "conversation-audits")

    both = audits.withColumn("is_row", F.lit(False)).unionByName(rows.filter(~F.col("dropped")).withColumn("is_row", F.lit(True)), allowMissingColumns=True)
    columns = [c.split()[0] for c in STATS.split(", ")]
    dealt = both.repartition("conv").sortWithinPartitions("conv", "is_row", *by_turn).select(*columns, "is_row", "role", "text")
    return dealt.mapInArrow(_digests, STATS + ", repaired_sha256 string").withColumnRenamed("conv", "conv_id")
