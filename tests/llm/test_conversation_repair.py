"""Conversation repair against an exhaustive search of edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from mercato.llm import conversation_repair as R
from mercato.llm.common import python_tasks

ROWS = T.StructType([T.StructField("conv", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                     T.StructField("text", T.StringType())] + [T.StructField(c, T.StringType()) for c in ("dropped", "case", "h", "cls", "is_row", "audit", "copy")])


def searched(rows):
    """rows of (role, text, fault) -> (cost, audit, roles and texts), the first that a queue by cost and audit completes."""
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, n, made, lines = heapq.heappop(queue)
        if n == len(rows) and re.fullmatch("(s?(ua)+)?", made):
            return cost, audit, lines
        state = (n, "e" if not made else made[-1])
        if state in done:
            continue
        done.add(state)
        steps = [("I", 2, r[0], f"{r}:", 0) for r in ("user", "assistant")]
        if n < len(rows):
            role, text, fault = rows[n]
            steps.append(("D", 3, "", None, 1))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] in ("s", "u", "a"):
                    steps.append(("K", extra, role[0], f"{role}:{text}", 1))
                steps += [("R", 2 + extra, r[0], f"{r}:{text}", 1) for r in ("user", "assistant")]
        for edit, price, initial, line, taken in steps:
            new = made + initial
            if re.fullmatch("(s?(ua)*u?)?", new):
                heapq.heappush(queue, (cost + price, audit + edit, n + taken, new, (*lines, line) if line is not None else lines))


def expected(rows, damage=True):
    """Rows (conv, turn, role, text) -> result by plain Python."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if fate:
            row = (turn, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
            kept += [row] * (2 if fate == 3 else 1)
    result = []
    for conv, kept in out.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, flagged = set(), []
        for _, role, text in kept:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            flagged.append((role, text, "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"))
            seen.add((role, text))
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit, lines = searched(flagged)
        faults = [f for _, _, f in flagged]
        initials = [r[:1] for r, _, _ in flagged]
        result.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                       sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit,
                       hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return result


def classes_of(rows):
    return bytes((R.INITIALS.get(r[:1], 0)) + (4 if f in ("blank", "duplicate") else 8 if f == "truncated" else 0) for r, _, f in rows)


def some_rows(rng, n):
    return [(rng.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]), "t", rng.choice(["", "", "", "truncated", "blank"])) for _ in range(n)]


def test_auction_finds_the_least_cheapest_edits(monkeypatch):
    rng = random.Random(3)
    for block in (4096, 3, 1):
        monkeypatch.setattr(R, "BLOCK", block)
        for _ in range(400):
            rows = some_rows(rng, rng.randint(0, 9))
            assert R.solve(classes_of(rows)) == searched(rows)[:2], rows


def test_prices_are_least_costs_and_no_arc_undercuts_them():
    later = R.auction_layer(None, None)
    assert later == [0, 4, 2, 0]
    for _ in range(200):
        c = random.Random(_).randrange(16)
        price = R.auction_layer(R.ROW_ARCS[c], later)
        for place in range(4):
            out = [cost + later[to] for _, cost, to in R.ROW_ARCS[c][place]] + [price[R._INSERT[place]] + R.INSERT]
            assert price[place] == min(out)
        later = price


def test_very_long_conversation():
    rng = random.Random(5)
    rows = some_rows(rng, 5_000)
    cost, audit = R.solve(classes_of(rows))
    assert len(audit) - audit.count("I") == len(rows)
    assert (cost, audit) == searched(rows)[:2]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = ["Hi.", "Why?", "so", "", " \t", "no end ", "done! ", "日本。", "é.", "x" * 5000 + ".", None]
    out = []
    for conv in [*range(150), None]:
        turns = rng.sample(range(20), rng.randint(1, 9))
        out += [(conv, t, rng.choice(["system", "user", "assistant", "assistant", "tool", None]), rng.choice(texts)) for t in turns]
        if rng.random() < 0.3:
            out.append((conv, None, "user", "no turn."))
    out += [out[0]] * 3  # repeated rows
    out += [(900, t, "user" if t % 2 == 0 else "assistant", "long.") for t in range(3000)]  # one hot conversation, all of it copies
    out += [(901, None, None, None), (902, -5, "user", "a."), (902, 2**40, "assistant", "b.")]
    return out


def test_repair_as_plain_python(spark, rows):
    python_tasks(spark)
    frame = spark.createDataFrame([(*r, *("x",) * 7) for r in rows], ROWS).repartition(5)
    for damage in (True, False):
        got = R.repair(frame, damage)
        assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(expected(rows, damage), key=str)


def test_conversation_with_no_row_left_and_empty_table(spark):
    python_tasks(spark)
    conv, turn = next((c, t) for c in range(50) for t in range(50) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(conv, turn, "user", "a.", *("x",) * 7)], ROWS)
    assert [tuple(r) for r in R.repair(frame).collect()] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert R.repair(frame.limit(0)).count() == 0
