"""Repeated byte strings by a sampled, range-partitioned suffix sort.

A byte is repeated if a ``LENGTH``-byte string that covers it also starts
anywhere else.  Sorting every suffix of a corpus would move each byte
``LENGTH`` times, so suffixes travel in bundles:

1.  Each window (the first ``LENGTH`` bytes of a suffix) has an anchor: the
    leftmost of its 8-byte grams with the smallest hash.  Equal windows have
    equal anchors at equal offsets.  Consecutive windows with one anchor, on
    one side of the middle, form a bundle; all windows of a bundle hold the
    same 104 bytes beside the anchor, and two equal windows lie in bundles with
    equal such bytes (the bundle's key).
    Equal bundles of one batch of texts travel as one row with all of their
    places, so what a passage in a third of all documents moves is far less
    than its copies.
2.  Bundles whose key occurs once hold no repeated window.  Of the others,
    those whose whole bytes occur twice are repeated as a whole: bundles with
    equal bytes are counted by partial aggregation, so a passage in a third of
    all documents costs no more than another.  What is repeated goes back to
    its batch, whose places become one row of merged spans for each document.
3.  What is left are the ends of repeated passages.  Their suffixes are
    range-partitioned by their leading tokens (the key's first bytes, with
    splitters that Spark samples) and sorted in each partition by multikey
    quicksort, eight bytes a token.  Equal neighbours of ``LENGTH`` bytes are
    repeated.  A key is never cut by a splitter; keys with more than
    ``CROWDED`` distinct bundles would crowd one partition, so their windows
    are compared across partitions, by digests grouped with partial
    aggregation.

Only digests, positions and the bytes of step 3 are shuffled; texts are
fetched again for documents that need it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import in_buckets, materialize, with_columns
from mercato.llm.jaccard_join import groups, mixed

LENGTH = 200
GRAM = 8
SIDE = (LENGTH - GRAM) // 2  # windows whose anchor is at least this far in hold SIDE bytes before it
CROWDED = 2000
#: Windows sorted at once in a task.
SORTED_AT_ONCE = 100_000
_POSITION_BITS = 20
_SEGMENT = (1 << _POSITION_BITS) - LENGTH


def anchors(data: np.ndarray) -> np.ndarray:
    """Position of each window's anchor; ``data`` is shorter than 2**20 bytes."""
    n = len(data) - GRAM + 1
    grams = np.ndarray((n,), "<u8", data.tobytes(), strides=(1,))
    low = np.uint64((1 << _POSITION_BITS) - 1)
    v = (mixed(grams) & ~low) | np.arange(n, dtype=np.uint64)
    w = LENGTH - GRAM + 1  # grams in a window
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = v
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - w + 1
    return (np.minimum(behind[:count], ahead[w - 1 : w - 1 + count]) & low).astype(np.int64)


def bundles(data: bytes) -> list[tuple[int, int, int]]:
    """(first window, number of windows, anchor) of a text's bundles."""
    out = []
    for s in range(0, max(0, len(data) - LENGTH + 1), _SEGMENT):
        part = np.frombuffer(data, np.uint8, min(len(data) - s, _SEGMENT + LENGTH - 1), s)
        a = anchors(part)
        far = a - np.arange(len(a)) >= SIDE
        first = np.nonzero(np.diff(a * 2 + far, prepend=-1))[0]
        counts = np.diff(np.append(first, len(a)))
        out += zip((first + s).tolist(), counts.tolist(), (a[first] + s).tolist(), strict=True)
    return out


def lead(data: bytes, first: int, anchor: int) -> bytes:
    """The bytes that all windows of a bundle hold beside the anchor."""
    at = anchor - SIDE if anchor - first >= SIDE else anchor
    return data[at : at + SIDE + GRAM]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bundles of texts; equal ones of a batch of texts are one row with all of their places."""
    task = TaskContext.get().partitionId()
    for nth, b in enumerate(batches):
        rows: list[list] = [[], [], [], [], []]
        for doc, t in enumerate(b["text"]):
            data = t.as_py()
            for first, n, anchor in bundles(data):
                offset = anchor - first
                key = xxhash.xxh3_64_intdigest(lead(data, first, anchor), seed=int(offset >= SIDE))
                whole = xxhash.xxh3_64_intdigest(data[first : first + n + LENGTH - 1], seed=offset + 2)
                for column, x in zip(rows, (doc, _signed(key), _signed(whole), first, n), strict=True):
                    column.append(x)
        doc, key, whole, first, n = (np.array(c, np.int64) for c in rows)
        order = np.lexsort((whole, key))
        doc, key, whole, first, n = doc[order], key[order], whole[order], first[order], n[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])
        at = np.flatnonzero(new)
        offsets, place = pa.array(np.append(at, len(key)), pa.int32()), pa.array(doc)
        lists = [pa.ListArray.from_arrays(offsets, c) for c in (b["id"].take(place), b["hash"].take(place), pa.array(first))]
        batch = pa.array(np.full(len(at), task << 32 | nth, np.int64))
        yield pa.RecordBatch.from_arrays([batch, pa.array(key[at]), pa.array(whole[at]), pa.array(n[at]), *lists],
                                         ["batch", "key", "whole", "n", "ids", "hashes", "firsts"])


def equal_windows(group: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Rows of ``windows`` (rows x LENGTH bytes) that equal another row with the same group.

    Multikey quicksort, level by level: rows that agree so far are sorted by
    their next eight bytes, and rows left alone drop out.
    """
    tokens = np.ascontiguousarray(windows).view(">u8")
    rows, same = np.arange(len(group)), group
    for depth in range(-1, tokens.shape[1]):
        value = same if depth < 0 else tokens[rows, depth]
        order = np.lexsort((value, same))
        rows, same, value = rows[order], same[order], value[order]
        new = np.ones(len(rows), bool)
        new[1:] = (same[1:] != same[:-1]) | (value[1:] != value[:-1])
        part = np.cumsum(new) - 1
        keep = np.bincount(part)[part] > 1 if len(part) else new
        rows, same = rows[keep], part[keep]
        if not len(rows):
            break
    return rows


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


SPANS = "spans array<struct<start:bigint,stop:bigint>>"
SPAN = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _sorted_locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bundles in order of their keys -> spans of single bundles' repeated windows."""
    held: list[tuple[int, dict]] = []

    def spans() -> pa.RecordBatch:
        group = np.concatenate([np.full(r["n"], g << 9) + r["offset"] - np.arange(r["n"]) for g, r in held])
        windows = np.concatenate([np.lib.stride_tricks.sliding_window_view(np.frombuffer(r["bytes"], np.uint8), LENGTH) for _, r in held])
        found = np.zeros(len(group), bool)
        found[equal_windows(group, windows)] = True
        out, at = [], 0
        for _, r in held:
            if r["single"]:
                out += [(r["id"], r["hash"], r["first"] + s, r["first"] + e - 1 + LENGTH) for s, e in _ranges(found[at : at + r["n"]])]
            at += r["n"]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 4)], schema=SPAN)

    count = 0
    for g, rows in enumerate(groups(batches, ("key",))):
        distinct = {r["whole"]: r for r in pa.Table.from_batches(rows).to_pylist()}
        if len(distinct) > 1:
            held += [(g, r) for r in distinct.values()]
            count += sum(r["n"] for r in distinct.values())
        if count >= SORTED_AT_ONCE:
            yield spans()
            count = 0
    if held:
        yield spans()


def _whole_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated bundles in order of their batches -> a row for each document with its spans, merged."""
    for rows in groups(batches, ("batch",)):
        t = pa.Table.from_batches(rows).combine_chunks()
        places = [t[c].combine_chunks() for c in ("ids", "hashes", "firsts")]
        sizes = pc.list_value_length(places[2]).to_numpy()
        ids, hashes, start = (c.flatten() for c in places)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        doc, hashed, start = ids.fill_null(0).to_numpy(), hashes.to_numpy(), start.to_numpy()
        stop = start + np.repeat(t["n"].to_numpy(), sizes) - 1 + LENGTH
        order = np.lexsort((start, hashed, doc, known))
        doc, hashed, known, start, stop = doc[order], hashed[order], known[order], start[order], stop[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1]) | (known[1:] != known[:-1])
        # the furthest stop so far in a document: documents are set apart by more than any position
        apart = (np.cumsum(new) - 1) * (int(stop.max()) + 1)
        furthest = np.maximum.accumulate(stop + apart)
        begins = new.copy()
        begins[1:] |= start[1:] + apart[1:] > furthest[:-1]
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(doc)) - 1
        spans = pa.StructArray.from_arrays([pa.array(start[first]), pa.array(furthest[last] - apart[last])], ["start", "stop"])
        at = np.flatnonzero(new[first])
        owner = first[at]
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[owner], mask=~known[owner]), pa.array(hashed[owner]), pa.ListArray.from_arrays(pa.array(np.append(at, len(first)), pa.int32()), spans)],
            ["id", "hash", "spans"])


def _crowded_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows: list[list] = [[], [], [], [], [], [], []]
        for r in b.to_pylist():
            for k in range(r["n"]):
                digest = xxhash.xxh3_128_intdigest(r["bytes"][k : k + LENGTH])
                for column, x in zip(rows, (r["key"], r["offset"] - k, _signed(digest >> 64), _signed(digest & (1 << 64) - 1),
                                            r["id"], r["hash"], r["first"] + k if r["single"] else None), strict=True):
                    column.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], ["key", "offset", "d1", "d2", "id", "hash", "start"])


def _with_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lead", pa.binary()), ("key", pa.int64()), ("whole", pa.int64()), ("single", pa.bool_()), ("crowded", pa.bool_()),
                        ("id", pa.int64()), ("hash", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("offset", pa.int64()), ("bytes", pa.binary())])
    for b in batches:
        for doc, hashed, t, wanted in zip(b["id"].to_pylist(), b["hash"].to_pylist(), b["text"], b["wanted"], strict=True):
            data, rows = t.as_py(), []
            at = {first: anchor for first, _, anchor in bundles(data)}
            for r in wanted.as_py():
                first, anchor = r["first"], at[r["first"]]
                rows.append({"lead": lead(data, first, anchor)[:16], "key": r["key"], "whole": r["whole"], "single": r["single"], "crowded": r["crowded"],
                             "id": doc, "hash": hashed, "first": first, "n": r["n"], "offset": anchor - first, "bytes": data[first : first + r["n"] + LENGTH - 1]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.hash") == F.col(f"{b}.hash"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, hash, text) -> id, hash, spans: what repeats in each document that has something."""
    data = docs.select("id", "hash", F.col("text").cast("binary").alias("text"))
    all_ = materialize(data.filter(F.length("text") >= LENGTH).mapInArrow(
        _digests, "batch long, key long, whole long, n long, ids array<bigint>, hashes array<bigint>, firsts array<bigint>"), "bundles")
    uses = F.sum(F.size("firsts")).alias("uses")
    often = all_.groupBy("key").agg(uses).filter("uses > 1").select("key")
    shared = materialize(all_.join(materialize(often, "shared-keys"), "key"), "shared-bundles")
    one = F.struct(F.get("ids", F.lit(0)).alias("id"), F.get("hashes", F.lit(0)).alias("hash"), F.get("firsts", F.lit(0)).alias("first"), "n")
    counted = materialize(shared.groupBy("key", "whole").agg(uses, F.min(one).alias("one")), "counted")
    # a batch of texts is bounded, and so is what comes back to it
    as_whole = (shared.join(counted.filter("uses > 1").select("key", "whole"), ["key", "whole"])
                .select("batch", "n", "ids", "hashes", "firsts").repartition("batch").sortWithinPartitions("batch")
                .mapInArrow(_whole_spans, f"id long, hash long, {SPANS}"))

    mixed_keys = (counted.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.min("uses").alias("least"))
                  .filter("kinds > 1 AND least = 1").select("key", (F.col("kinds") > CROWDED).alias("crowded")))
    ends = counted.join(materialize(mixed_keys, "mixed-keys"), "key").select(
        "one.id", "one.hash", F.struct("key", "whole", "one.first", "one.n", (F.col("uses") == 1).alias("single"), "crowded").alias("bundle"))
    wanted = materialize(ends.groupBy("id", "hash").agg(F.collect_list("bundle").alias("wanted")), "wanted")  # a document's own bundles
    # repeated rows of a document are one here: the others would bring the same bytes again
    own = in_buckets(data, wanted, ["id", "hash"]).groupBy("id", "hash").agg(F.first("text").alias("text"))
    placed = materialize(
        own.alias("d").join(wanted.alias("w"), _same("d", "w")).select("d.id", "d.hash", "d.text", "w.wanted")
        .mapInArrow(_with_bytes, "lead binary, key long, whole long, single boolean, crowded boolean, id long, hash long, first long, n long, offset long, bytes binary"),
        "suffix-bundles")
    sorted_ = (placed.filter("NOT crowded").repartitionByRange("lead", "key")
               .sortWithinPartitions("lead", "key").mapInArrow(_sorted_locally, "id long, hash long, start long, stop long"))
    crowded = (placed.filter("crowded").dropDuplicates(["key", "whole"]).select("key", "id", "hash", "first", "n", "offset", "single", "bytes")
               .mapInArrow(_crowded_windows, "key long, offset long, d1 long, d2 long, id long, hash long, start long"))
    window = ["key", "offset", "d1", "d2"]
    twice = crowded.groupBy(*window).agg(F.count(F.lit(1)).alias("uses")).filter("uses > 1").drop("uses")
    across = crowded.filter("start IS NOT NULL").join(twice, window).select("id", "hash", "start", (F.col("start") + LENGTH).alias("stop"))
    single = sorted_.union(across).select("id", "hash", F.array(F.struct("start", "stop")).alias("spans"))
    # a document's repeated rows bring equal lists, which are one here
    return materialize(as_whole.union(single).groupBy("id", "hash").agg(
        F.flatten(F.collect_set("spans")).alias("spans")), "repeated-spans")


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[list[int]] = []
    for s, e in sorted((s["start"], s["stop"]) for s in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for s, e in runs:
        kept.append(data[at:s])
        at = e
    return b"".join([*kept, data[at:]])


CUT = "n_removed long, n_spans long, kept binary, kept_text string"
ADDED = ("n_bytes", "n_removed", "n_spans", "kept")


def _cut(b: pa.RecordBatch) -> list[pa.Array]:
    rows = []
    for t, s in zip(b["text"], b["spans"], strict=True):
        runs = merged(s.as_py() or [])
        kept = without(t.as_py().encode(), runs)
        rows.append((sum(e - s for s, e in runs), len(runs), kept, kept.decode("utf-8", "ignore")))
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.string()), strict=True)]


def dedup(docs: DataFrame) -> DataFrame:
    """(id, text, any more) -> + n_bytes, n_removed, n_spans, kept (bytes), and text without what repeats.

    Texts are UTF-8 bytes; null is empty.  Every byte that a repeated 200-byte
    string covers is removed, at all its places, in equal documents too, so
    there are no ties.  The new text drops characters of which only a part is
    left.  Documents under 200 bytes lose nothing; long ones are bundled in
    pieces of a million windows.  Repeated rows are copies of each other; rows
    that share an id are told apart by their texts.  Null ids are ids.  An
    empty table gives an empty result.  Other columns are passed on whatever
    their names, but one with the name of an added column is replaced.
    """
    rest = [c for c in docs.columns if c not in ("id", "text", *ADDED)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("id").cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"),
                        *([F.struct(*[F.col(f"`{c}`") for c in rest]).alias("more")] if rest else []))
    more = ["more"] if rest else []
    spans = repeated_spans(keyed)
    size = F.octet_length("text").cast("long").alias("n_bytes")
    touched = in_buckets(keyed, spans, ["id", "hash"]).alias("d").join(spans.alias("s"), _same("d", "s"), "left")
    hit = (with_columns(touched.select("d.id", *[f"d.{c}" for c in (*more, "text")], "s.spans"), CUT, _cut)
           .select("id", *more, size, "n_removed", "n_spans", "kept", F.col("kept_text").alias("text")))
    none = F.lit(0).cast("long")
    clean = in_buckets(keyed, spans, ["id", "hash"], "left_anti").select(
        "id", *more, size, none.alias("n_removed"), none.alias("n_spans"), F.col("text").cast("binary").alias("kept"), "text")
    return hit.unionByName(clean).select("id", *[F.col("more").getField(c).alias(c) for c in rest], *ADDED, "text")
