"""Hard-negative mining with segment summaries that bound inner products.

Of every vector the index stores, for segments of 16 and of 4 components and for
the whole, the segment's mean and its deviation (the norm of what is left when
the mean is taken away).  A segment's part of an inner product is
``length * mean * mean'`` plus a rest of at most ``deviation * deviation'``
either way, so the sum over segments bounds the product from both sides.  A
row is bounded by the whole first, then by its segments of 16 and of 4; what no
bound rules out at a level goes to the next one, and what is left after the
last is scored exactly, in integers.

Positives (the best rows of the anchor's label) and negatives (the best rows of
other labels in a band below each positive's score) are two passes of one
search: the index is dealt evenly to lanes, the anchors to groups of about
``GROUP``; a task holds one group and streams one lane's blocks past it, so the
index is read once a group and a block is held once.  Each task gives a few
rows an anchor, and a ranked window keeps the best of those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.bitsliced import quantised
from mercato.llm.common import materialize

BLOCK_ROWS = 4096
GROUP = 2048
SEGMENTS = (16, 4)  # components of a segment at the levels after the whole
SLACK = 1e-6  # of the norms' product: more than what float32 summaries can be off


def padded(x: np.ndarray) -> np.ndarray:
    """Rows with zeros up to a multiple of the longest segment."""
    return np.pad(x, ((0, 0), (0, -x.shape[1] % SEGMENTS[0] or (0 if x.shape[1] else SEGMENTS[0]))))


def summaries(x: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Of each level: length of a segment, means and deviations (rows, segments)."""
    out = []
    for length in (x.shape[1], *SEGMENTS):
        parts = x.reshape(len(x), -1, length).astype(np.float64)
        means = parts.mean(axis=2)
        out.append((length, means.astype(np.float32), np.sqrt(((parts - means[:, :, None]) ** 2).sum(axis=2)).astype(np.float32)))
    return out


class Block:
    """Rows of the index, ordered by label and id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, levels: list) -> None:
        self.ids, self.labels, self.x, self.levels = ids, labels, x, levels
        self.norm = float(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
        self.largest = float(np.abs(x.astype(np.float64)).max(initial=0))

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact products: in doubles where every partial sum is a whole number that they hold."""
        if self.largest * float(np.abs(q.astype(np.float64)).max(initial=0)) * len(q) < 2**53:
            return (self.x[rows].astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        return self.x[rows].astype(np.int64) @ q


class Anchor:
    """A query with its summaries, and the best rows met so far."""

    def __init__(self, id_: int, label: int, vector: list[int], k: int) -> None:
        self.id, self.label, self.k = id_, label, k
        self.vector = np.array(vector, np.int64)
        self.at_dims: dict[int, tuple] = {}

    def fitted(self, dims: int) -> tuple[np.ndarray, list, float]:
        """The vector cut or filled with zeros to a block's length, its summaries and norm."""
        if dims not in self.at_dims:
            q = np.zeros(dims, np.int64)
            q[: min(dims, len(self.vector))] = self.vector[:dims]
            self.at_dims[dims] = q, [(n, m[0].astype(np.float64), d[0].astype(np.float64)) for n, m, d in summaries(q[None])], float(np.sqrt((q.astype(np.float64) ** 2).sum()))
        return self.at_dims[dims]

    def refine(self, block: Block, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that no bound rules out, and their exact scores."""
        q, levels, norm = self.fitted(block.x.shape[1])
        slack = 1 + SLACK * norm * block.norm
        for (length, means, devs), (_, mean, dev) in zip(block.levels, levels, strict=True):
            if not len(rows):
                break
            middle, spread = length * (means[rows] @ mean), devs[rows] @ dev + slack
            rows = rows[self.open(middle - spread, middle + spread)]
        return rows, block.scores(rows, q)

    def best(self, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Places of the k best: higher scores first, ties to smaller ids."""
        if len(scores) > 8 * self.k:  # ties at the last place stay in
            near = np.nonzero(scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k])[0]
            return near[np.lexsort((ids[near], -scores[near]))[: self.k]]
        return np.lexsort((ids, -scores))[: self.k]


class ForPositives(Anchor):
    def __init__(self, id_: int, label: int, vector: list[int], k: int, bands: list) -> None:
        super().__init__(id_, label, vector, k)
        self.scores = self.ids = np.zeros(0, np.int64)

    def meet(self, block: Block) -> None:
        lo, hi = np.searchsorted(block.labels, self.label), np.searchsorted(block.labels, self.label, "right")
        rows = np.arange(lo, hi)[block.ids[lo:hi] != self.id]
        rows, scores = self.refine(block, rows)
        scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, block.ids[rows]))
        keep = self.best(scores, ids)
        self.scores, self.ids = scores[keep], ids[keep]

    def open(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """At least k rows reach the k-th highest lower bound, so what stays below it is out."""
        least = float(self.scores[-1]) if len(self.scores) == self.k else -np.inf
        if len(low) > self.k:
            least = max(least, float(np.partition(low, len(low) - self.k)[len(low) - self.k]))
        return high >= least

    def found(self) -> Iterator[tuple]:
        return ((self.id, 0, None, None, int(i), int(s)) for i, s in zip(self.ids, self.scores, strict=True))


class ForNegatives(Anchor):
    def __init__(self, id_: int, label: int, vector: list[int], k: int, bands: list) -> None:
        super().__init__(id_, label, vector, k)
        self.bands = [(b["nth"], b["id"], b["score"], b["least"]) for b in bands if b["least"] <= b["score"]]
        none = np.zeros(0, np.int64)
        self.held = [(none, none) for _ in self.bands]

    def meet(self, block: Block) -> None:
        if not self.bands:
            return
        rows, scores = self.refine(block, np.nonzero((block.labels != self.label) & (block.ids != self.id))[0])
        for at, (_, _, most, least) in enumerate(self.bands):
            inside = (scores >= least) & (scores <= most)
            if inside.any():
                s, i = np.concatenate((self.held[at][0], scores[inside])), np.concatenate((self.held[at][1], block.ids[rows[inside]]))
                keep = self.best(s, i)
                self.held[at] = s[keep], i[keep]

    def open(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """What may lie in a band, at or above the last of its k best so far."""
        out = np.zeros(len(low), bool)
        for (_, _, most, least), (scores, _) in zip(self.bands, self.held, strict=True):
            out |= (low <= most) & (high >= (float(scores[-1]) if len(scores) == self.k else least))
        return out

    def found(self) -> Iterator[tuple]:
        return ((self.id, nth, pos, score, int(i), int(s)) for (nth, pos, score, _), (ss, ids) in zip(self.bands, self.held, strict=True)
                for i, s in zip(ids, ss, strict=True))


INDEX = "lane int, ids binary, labels binary, dims long, width int, x binary, means binary, devs binary"


def build_index(vectors: DataFrame, lanes: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, label, q) -> blocks of rows with their summaries, dealt evenly to lanes."""
    names = [c.split()[0] for c in INDEX.split(", ")]

    def block(rows: pa.Table, lane: int) -> pa.RecordBatch:
        ids, labels, q = rows["id"].to_numpy().astype(np.int64), rows["label"].to_numpy().astype(np.int64), rows["q"].to_pylist()
        x = np.zeros((len(q), max(map(len, q))), np.int64)
        for i, r in enumerate(q):
            x[i, : len(r)] = r
        order = np.lexsort((ids, labels))
        x = padded(x[order])
        levels = summaries(x)
        width = next(w for w in (2, 4, 8) if w == 8 or np.abs(x).max(initial=0) < 1 << (8 * w - 1))
        return pa.RecordBatch.from_pydict(dict(zip(names, (
            pa.array([lane], pa.int32()), [ids[order].tobytes()], [labels[order].tobytes()], [x.shape[1]], pa.array([width], pa.int32()),
            [x.astype(f"<i{width}").tobytes()], [b"".join(m.tobytes() for _, m, _ in levels)], [b"".join(d.tobytes() for _, _, d in levels)]), strict=True)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, held, count = TaskContext.get().partitionId() % lanes, [], 0
        for b in batches:
            while b.num_rows:
                held.append(b.slice(0, block_rows - count))
                count += held[-1].num_rows
                b = b.slice(held[-1].num_rows)
                if count == block_rows:
                    yield block(pa.Table.from_batches(held), lane)
                    held, count = [], 0
        if count:
            yield block(pa.Table.from_batches(held), lane)

    return vectors.select("id", "label", "q").repartition(lanes).mapInArrow(blocks, INDEX)


def opened(r: dict) -> Block:
    ids = np.frombuffer(r["ids"], np.int64)
    n, dims, levels, at = len(ids), r["dims"], [], 0
    for length in (dims, *SEGMENTS):
        size = 4 * n * (dims // length)
        levels.append((length, *(np.frombuffer(r[c], np.float32, size // 4, at).reshape(n, -1) for c in ("means", "devs"))))
        at += size
    return Block(ids, np.frombuffer(r["labels"], np.int64), np.frombuffer(r["x"], f"<i{r['width']}").reshape(n, dims), levels)


def _search(kind: type, k: int):
    names = ["anchor_id", "nth", "positive_id", "positive_score", "id", "score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: list[Anchor] = []
        for b in batches:
            for r in b.to_pylist():
                if r["ids"] is None:
                    anchors.append(kind(r["id"], r["label"], r["q"], k, r["bands"]))
                    continue
                block = opened(r)
                for a in anchors:
                    a.meet(block)
        for at in range(0, len(anchors), 512):
            rows = [f for a in anchors[at : at + 512] for f in a.found()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 6)], names)

    return search


def meet(index: DataFrame, anchors: DataFrame, lanes: int, groups: int, kind: type, k: int) -> DataFrame:
    """Every group of anchors against every lane of the index, one task each: anchors come first, blocks after them."""
    both = (index.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
            .unionByName(anchors.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))), allowMissingColumns=True)
            .withColumn("part", (F.col("lane") * groups + F.col("grp")).cast("int")))
    dealt = both.repartitionById(lanes * groups, F.col("part")).sortWithinPartitions(F.col("ids").isNotNull())
    return (dealt.select("ids", "labels", "dims", "width", "x", "means", "devs", "id", "label", "q", "bands")
            .mapInArrow(_search(kind, k), "anchor_id long, nth long, positive_id long, positive_score long, id long, score long"))


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, least_percent: int = 80, block_rows: int = BLOCK_ROWS, group: int = GROUP) -> DataFrame:
    """(id, label, vector) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``.  Scores are inner
    products of floor(256 * x), higher first, ties to the smaller id.  Of each
    anchor's best ``positives`` rows of its label, every one gets the best
    ``negatives`` rows of other labels whose score is at least
    ``least_percent`` percent of the positive's and at most the positive's.

    Rows whose id, label or vector is null, or whose vector holds a null or
    non-finite component, take no part.  A repeated id stands as often as the
    table holds it as positive or negative, but is one anchor (with its
    smallest vector, then label), and no row with the anchor's id is one of its
    own.  Vectors of unequal length are compared as if the shorter one went on
    with zeros; an empty one scores 0.  Where the label has no other row, or no
    row lies in the band, there is no row; fewer than asked give all.  An empty
    table gives an empty result.  Other columns, whatever their names, are left
    out.  Scores must fit a long.
    """
    spark = vectors.sparkSession
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    usable = (vectors.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), quantised(F.col("vector")).alias("q"))
              .filter("id IS NOT NULL AND label IS NOT NULL AND q IS NOT NULL"))
    index = materialize(build_index(usable, lanes, block_rows), "segment-index")
    chosen = usable.filter(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("q", "label")).alias("a")).select("id", "a.label", "a.q")
    chosen = materialize(chosen, "anchors")
    groups = max(1, -(-chosen.count() // group))
    anchors = chosen.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))

    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    best = (meet(index, anchors.withColumn("bands", F.expr("CAST(NULL AS array<struct<nth:bigint,id:bigint,score:bigint,least:bigint>>)")),
                 lanes, groups, ForPositives, positives)
            .withColumn("nth", F.row_number().over(order).cast("long")).filter(F.col("nth") <= positives)
            # the least whole score s with 100 * s >= least_percent * score, from quotients that can't overflow
            .withColumn("least", F.expr(f"{least_percent} * (score DIV 100) + CAST(ceil({least_percent} * (score % 100) / 100D) AS BIGINT)")))
    bands = best.groupBy("anchor_id").agg(F.collect_list(F.struct("nth", "id", "score", "least")).alias("bands"))
    banded = materialize(anchors.join(bands, F.col("id") == F.col("anchor_id")).select("id", "label", "q", "grp", "bands"), "anchors-with-positives")

    within = Window.partitionBy("anchor_id", "nth").orderBy(F.desc("score"), "id")
    return (meet(index, banded, lanes, groups, ForNegatives, negatives)
            .withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
