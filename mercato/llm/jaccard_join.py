"""N-gram Jaccard self-join with Bayesian candidate pruning.

Texts with the same set of five-word shingles are one node (its id is their
smallest document id).  MinHash bands propose buckets of nodes; inside a
bucket, MinHash values of all pairs are compared ``STEP`` at a time, and a
pair is dropped once the posterior probability that its similarity reaches the
threshold, given the matches so far, falls below ``TOLERANCE`` (uniform prior:
the posterior is a Beta distribution).  What survives groups the nodes into
candidate components, and inside each component all pairs are verified exactly
on whole shingle sets.

Pairs are compared in blocks inside tasks and never become rows: a block pair
gives each node's number of links and a spanning forest of them.  Buckets and
components of any size are split into blocks, and every pair of blocks is
compared, so no bucket is capped and none is held by one task.

A pair of similarity 0.8 shares no band with probability (1 - 0.8^4)^32 = 5e-8,
and is pruned with probability under 1e-6.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import in_buckets, materialize
from mercato.llm.components import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
COMPARED, STEP = 64, 16
TOLERANCE = 1e-7
#: Nodes of a block: of signatures in a bucket, of texts in a component.
BUCKET_BLOCK = 1024
TEXT_BLOCK = 512

_BLANKS = str.maketrans(dict.fromkeys("\t\n\x0b\x0c\r", " "))
_random = np.random.default_rng(20240501)
_SCALE = _random.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_SHIFT = _random.integers(0, 2**63, HASHES, dtype=np.uint64)
_POSITION = _random.integers(1, 2**63, WORDS, dtype=np.uint64) | np.uint64(1)
_BAND = _random.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of a text's five-word shingles; fewer words make one shingle, none make none."""
    words = [w for w in (text or "").translate(_BLANKS).split(" ") if w]
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    size = min(WORDS, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += mixed(h[k : k + n] * _POSITION[k])
    return np.unique(mixed(total))


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values, unsigned 32-bit."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(found), 2048):
        part = mixed(found[at : at + 2048, None] * _SCALE + _SHIFT) >> np.uint64(32)
        low = np.minimum(low, part.min(0))
    return low.astype(np.uint32)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """Values compared -> fewest matches that keep a pair.

    After m matches of n the posterior of the similarity is Beta(m + 1, n - m + 1),
    which reaches the threshold t with the probability that a binomial of n + 1
    trials at t is m at most.
    """
    keep = {}
    for n in range(STEP, COMPARED + 1, STEP):
        below = 0.0
        for m in range(n + 1):
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                keep[n] = m
                break
    return keep


def surviving(a: np.ndarray, b: np.ndarray, keep: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b whose pairs are not pruned; signatures are compared step by step."""
    left = np.repeat(np.arange(len(a)), len(b))
    right = np.tile(np.arange(len(b)), len(a))
    matches = np.zeros(len(left), np.int16)
    for n, least in keep.items():
        part = slice(n - STEP, n)
        matches += (a[left, part] == b[right, part]).sum(1, dtype=np.int16)
        alive = matches >= least
        left, right, matches = left[alive], right[alive], matches[alive]
    return left, right


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Each row's smallest connected row."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def block_pairs(frame: DataFrame, group: str, size: Column, block: int) -> DataFrame:
    """Rows of ``group`` dealt to blocks: one row for each pair of blocks (i <= j) that its own block is in.

    ``size`` is the group's number of rows; adds i, j, side (0: block i, 1: block j).
    """
    blocks = F.ceil(size / block).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(group)), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j"), (o < F.col("own")).cast("int").alias("side")))
    return (frame.withColumn("blocks", blocks).withColumn("own", own).withColumn("pair", F.explode(pairs))
            .select(*frame.columns, "pair.i", "pair.j", "pair.side"))


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive rows with equal keys, over batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        columns = [b[k].to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.nonzero(change)[0].tolist(), b.num_rows]
        for s, e in zip(starts, starts[1:], strict=False):
            key = tuple(c[s] for c in columns)
            if key != last and held:
                yield held
                held = []
            last = key
            held.append(b.slice(s, e - s))
    if held:
        yield held


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, sigs = [], []
        for t in b["text"]:
            found = shingles(t.as_py())
            keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
            sigs.append(signature(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays([b["id"], pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], ["id", "key", "sig"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            sigs = np.frombuffer(b"".join(b["sig"].to_pylist()), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
            keys = mixed((mixed(sigs * _BAND) * _BAND[:, ::-1]).sum(2, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(b["node"].to_numpy(), BANDS))], ["bucket", "node"])


def _narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 16 low bits of the values that are compared."""
    for b in batches:
        if b.num_rows:
            sigs = np.frombuffer(b"".join(b["wide"].to_pylist()), np.uint32).reshape(-1, HASHES)[:, :COMPARED].astype(np.uint16)
            yield pa.RecordBatch.from_arrays([b["node"], pa.array([s.tobytes() for s in sigs], pa.binary())], ["node", "sig"])


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keep, out = least_matches(), ([], [])
    for rows in groups(batches, ("bucket", "i", "j")):
        t = pa.Table.from_batches(rows)
        node, side = t["node"].to_numpy(), t["side"].to_numpy()
        if t["i"][0].as_py() != t["j"][0].as_py() and not 0 < side.sum() < len(side):
            continue
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint16).reshape(-1, COMPARED)
        inside = t["i"][0].as_py() == t["j"][0].as_py()
        first = np.arange(len(node)) if inside else np.nonzero(side == 0)[0]
        second = first if inside else np.nonzero(side == 1)[0]
        edges: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(first), 128):
            x = first[at : at + 128]
            y = second[second > x[0]] if inside else second
            left, right = surviving(sig[x], sig[y], keep)
            left, right = x[left], y[right]
            edges.append((left, right))
        label = forest(len(node), *(np.concatenate(e) for e in zip(*edges, strict=True)))
        moved = np.nonzero(label != np.arange(len(node)))[0]
        out[0].append(node[moved])
        out[1].append(node[label[moved]])
        if sum(map(len, out[0])) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o), pa.int64()) for o in out], ["a", "b"])
            out = ([], [])
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o), pa.int64()) for o in out], ["a", "b"])


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sorted sets, by products of
    membership columns; members of a single set have no column."""
    owner = np.repeat(np.arange(len(sets)), list(map(len, sets)))
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.concatenate(([True], values[1:] != values[:-1])) if len(values) else np.zeros(0, bool)
    column = np.cumsum(fresh) - 1
    shared = np.bincount(column)[column] > 1 if len(column) else fresh
    column, owner = column[shared], owner[shared]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    cuts = np.searchsorted(column, np.arange(0, column[-1] + 1 + width, width)) if len(column) else []
    for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
        m = np.zeros((len(sets), width), np.float32)
        m[owner[s:e], column[s:e] - k * width] = 1
        out += m @ m.T
    return out


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in groups(batches, ("component", "i", "j")):
        t = pa.Table.from_batches(rows)
        sets = [shingles(x.as_py()) for x in t["text"]]
        once = [*{(n.as_py(), s.tobytes()): k for k, (n, s) in enumerate(zip(t["node"], sets, strict=True))}.values()]  # repeated rows
        sets = [sets[k] for k in once]
        node, side = t["node"].to_numpy()[once], t["side"].to_numpy()[once]
        sizes = np.array(list(map(len, sets)), np.float64)
        common = intersections(sets)
        near = common >= THRESHOLD * (sizes[:, None] + sizes[None] - common) - 1e-6
        near &= node[:, None] != node[None]
        if t["i"][0].as_py() != t["j"][0].as_py():
            near &= side[:, None] != side[None]
        label = forest(len(node), *np.nonzero(near))
        yield pa.RecordBatch.from_arrays(
            [pa.array(node, pa.int64()), pa.array(near.sum(1), pa.int64()), pa.array(node[label], pa.int64())], ["node", "links", "towards"])


def join(docs: DataFrame) -> DataFrame:
    """(id, text) -> doc_id, class_id, rep_id, n_copies, n_links; one row a document.

    ``rep_id``: smallest id of the documents with the same shingle set;
    ``n_copies``: how many documents those are; ``n_links``: other shingle sets
    with a Jaccard similarity of 0.8 or more; ``class_id``: smallest id that
    links lead to.  Texts without a word (null ones as well) are linked to
    nothing and stand each for themselves.  A row without an id is linked to
    nothing and has null ids.  Rows that share an id are in one class.  Ties
    can't occur: ids name nodes.  Texts are taken whole, however long; the
    shingle hashes of one text are held at a time.  An empty table gives an
    empty result.  Other columns, whatever their names, are left out.
    """
    docs = docs.select(F.col("id").cast("long").alias("id"), "text")
    sketches = materialize(docs.mapInArrow(_sketches, "id long, key binary, sig binary"), "sketches")
    usable = F.col("id").isNotNull() & F.col("key").isNotNull()
    nodes = materialize(sketches.filter(usable).groupBy("key").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("n_copies"), F.first("sig").alias("sig")), "nodes")

    bands = nodes.select("node", "sig").mapInArrow(_bands, "bucket long, node long")
    # buckets of two or more; those with the same members as another one are compared once
    filled = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    distinct = materialize(filled.filter("size > 1").groupBy("size", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "size"), "buckets")
    held = block_pairs(bands.join(distinct, "bucket"), "bucket", F.col("size"), BUCKET_BLOCK)
    compact = nodes.select("node", F.col("sig").alias("wide")).mapInArrow(_narrow, "node long, sig binary")
    candidates = (held.join(compact, "node").select("bucket", "i", "j", "side", "node", "sig")
                  .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(_pruned, "a long, b long"))

    grouped = materialize(components(candidates), "candidate-components")
    sizes = materialize(grouped.groupBy("label").agg(F.count(F.lit(1)).alias("size")), "component-sizes")
    held = grouped.join(sizes, "label").select(F.col("label").alias("component"), "node", "size")
    members = in_buckets(docs, grouped.select(F.col("node").alias("id")), ["id"])
    texts = members.join(held, F.col("id") == F.col("node")).select("component", "node", "size", "text")
    placed = block_pairs(texts, "component", F.col("size"), TEXT_BLOCK)
    verified = materialize(
        placed.select("component", "i", "j", "side", "node", "text").repartition("component", "i", "j")
        .sortWithinPartitions("component", "i", "j", "node").mapInArrow(_verified, "node long, links long, towards long"), "verified")

    links = verified.groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = components(verified.select(F.col("node").alias("a"), F.col("towards").alias("b"))).select(F.col("node").alias("of"), "label")
    described = materialize(
        nodes.select("key", "node", "n_copies").join(links, "node", "left").join(classes, F.col("node") == F.col("of"), "left")
        .select("key", F.col("node").alias("rep_id"), "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                F.coalesce("label", "node").alias("class_id")), "described")
    alone = ~usable
    return (sketches.filter(usable).select("id", "key").join(described, "key")
            .select(F.col("id").alias("doc_id"), "class_id", "rep_id", "n_copies", "n_links")
            .unionByName(sketches.filter(alone).select(
                F.col("id").alias("doc_id"), F.col("id").alias("class_id"), F.col("id").alias("rep_id"),
                F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))))

