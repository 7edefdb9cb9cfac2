"""Exact top-k search by inner product over a bit-sliced index.

Index: every vector's integer components are cut into bit slices, one bitmap
over the rows of a block for each component and bit.  A query's inner product
with all rows of a block is then a sum of bitmaps: bit k of the query's
component d adds component d's slice j at weight j + k.  Bitmaps of one weight
are added three at a time by full adders (XOR and majority), carries go to the
next weight, and what remains is one bitmap for each bit of the score.  The k
best rows are selected from the most significant slice downward; rows that tie
at the last place are told apart exactly, by the smaller id.

The index is written in blocks of ``BLOCK_ROWS`` rows and the queries are
packed in blocks of ``QUERY_ROWS``; every query block meets every index block
once.  A block gives k rows a query, and a ranked window keeps the k best of
those.  Nothing goes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import materialize

BLOCK_ROWS = 8192
QUERY_ROWS = 128


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null if the vector can't take part."""
    usable = vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix; missing trailing components are 0."""
    rows = column.to_pylist()
    m = np.zeros((len(rows), max(map(len, rows), default=0)), dtype=np.int64)
    for i, r in enumerate(rows):
        m[i, : len(r)] = r
    return m


def slice_block(x: np.ndarray) -> tuple[int, np.ndarray]:
    """(n, d) integers -> base, slices (d, bits, words): bit j of x - base, rows as bits."""
    base = int(x.min()) if x.size else 0
    y = (x - base).astype(np.uint64)
    bits = max(1, int(y.max()).bit_length()) if x.size else 1
    words = -(-len(x) // 64)
    out = np.zeros((x.shape[1], bits, words * 8), dtype=np.uint8)
    for j in range(bits):
        packed = np.packbits(((y >> np.uint64(j)) & np.uint64(1)).astype(np.uint8).T, axis=1, bitorder="little")
        out[:, j, : packed.shape[1]] = packed
    return base, out.view(np.uint64)


def add_bitmaps(weights: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Sum of bitmaps by weight -> one bitmap for each bit of the sum, lowest first."""
    total, w = [], 0
    while weights:
        stack = weights.pop(w, None)
        if stack is None:
            total.append(None)
            w += 1
            continue
        a, carries = stack[0] if len(stack) == 1 else np.concatenate(stack), weights.get(w + 1, [])
        while len(a) > 2:
            t = len(a) // 3
            p, q, r = a[:t], a[t : 2 * t], a[2 * t : 3 * t]
            x = p ^ q
            carries.append((p & q) | (x & r))
            a = np.concatenate((x ^ r, a[3 * t :]))
        if len(a) == 2:
            carries.append(a[:1] & a[1:])
            a = a[:1] ^ a[1:]
        total.append(a[0])
        if carries:
            weights[w + 1] = carries
        w += 1
    return total


def score_slices(both: np.ndarray, query: np.ndarray) -> list[np.ndarray]:
    """Bit slices of sum |q_d| * z_d; z_d is y_d, or its complement where q_d < 0."""
    size, sign = np.abs(query), (query < 0).astype(int)
    weights: dict[int, list[np.ndarray]] = {}
    for k in range(int(size.max()).bit_length() if size.size else 0):
        dims = np.nonzero((size >> k) & 1)[0]
        if len(dims):
            chosen = both[sign[dims], dims]
            for j in range(both.shape[2]):
                weights.setdefault(j + k, []).append(chosen[:, j])
    return add_bitmaps(weights)


def select_top(slices: list[np.ndarray], candidates: np.ndarray, k: int, n: int) -> np.ndarray:
    """Rows of the k highest sums, ties to the lower row number."""
    sure, open_ = np.zeros_like(candidates), candidates
    for s in reversed(slices):
        if s is None:
            continue
        high = open_ & s
        found = int(np.bitwise_count(sure | high).sum())
        if found > k:
            open_ = high
        else:
            sure, open_ = sure | high, open_ & ~s
            if found == k:
                open_ = np.zeros_like(open_)
                break
    rows = np.nonzero(np.unpackbits(sure.view(np.uint8), count=n, bitorder="little"))[0]
    ties = np.nonzero(np.unpackbits(open_.view(np.uint8), count=n, bitorder="little"))[0]
    return np.concatenate((rows, ties[: k - len(rows)]))


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, q array<bigint>) -> one row a block: slot, ids, dims, base, bits, slices.

    Blocks are cut from each partition as its rows stream by: no shuffle, and
    no task holds more than one block.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, count, seq = TaskContext.get().partitionId(), [], 0, 0

        def block(rows: pa.Table) -> pa.RecordBatch:
            ids = rows["id"].to_numpy().astype(np.int64)
            order = np.argsort(ids, kind="stable")
            x = _matrix(rows["q"])[order]
            base, slices = slice_block(x)
            return pa.RecordBatch.from_pydict(
                {"slot": [part * 2**32 + seq], "ids": [ids[order].tobytes()], "dims": [x.shape[1]], "base": [base],
                 "bits": [slices.shape[1]], "slices": [slices.tobytes()]}, schema=schema)

        schema = pa.schema([("slot", pa.int64()), ("ids", pa.binary()), ("dims", pa.int64()),
                            ("base", pa.int64()), ("bits", pa.int64()), ("slices", pa.binary())])
        for b in batches:
            while b.num_rows:
                held.append(b.slice(0, block_rows - count))
                count += held[-1].num_rows
                b = b.slice(held[-1].num_rows)
                if count == block_rows:
                    yield block(pa.Table.from_batches(held))
                    held, count, seq = [], 0, seq + 1
        if count:
            yield block(pa.Table.from_batches(held))

    return vectors.select("id", "q").mapInArrow(
        blocks, "slot long, ids binary, dims long, base long, bits long, slices binary")


def pack_queries(vectors: DataFrame, rows: int = QUERY_ROWS) -> DataFrame:
    """(id, q) -> one row for up to ``rows`` queries: qids, qdims, qs."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                m = _matrix(part["q"])
                yield pa.RecordBatch.from_pydict(
                    {"qids": [part["id"].to_numpy(zero_copy_only=False).astype(np.int64).tobytes()],
                     "qdims": [m.shape[1]], "qs": [m.tobytes()]},
                    schema=pa.schema([("qids", pa.binary()), ("qdims", pa.int64()), ("qs", pa.binary())]))

    return vectors.select("id", "q").mapInArrow(pack, "qids binary, qdims long, qs binary")


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index = None, None
        for b in batches:
            for r in b.to_pylist():
                if r["slot"] != last:
                    ids = np.frombuffer(r["ids"], dtype=np.int64)
                    n, dims = len(ids), r["dims"]
                    y = np.frombuffer(r["slices"], dtype=np.uint64).reshape(dims, r["bits"], -1) if dims else np.zeros((0, 1, -(-n // 64)), np.uint64)
                    every = np.zeros(y.shape[2] * 8, dtype=np.uint8)
                    every[: -(-n // 8)] = np.packbits(np.ones(n, np.uint8), bitorder="little")
                    last, index = r["slot"], (ids, dims, r["base"], 2 ** r["bits"] - 1, np.stack((y, ~y)), every.view(np.uint64))
                ids, dims, base, most, both, every = index
                qids = np.frombuffer(r["qids"], dtype=np.int64)
                queries = np.frombuffer(r["qs"], dtype=np.int64).reshape(len(qids), r["qdims"])
                out: tuple[list, list, list] = ([], [], [])
                for qid, q in zip(qids, queries, strict=True):
                    q = np.pad(q[:dims], (0, max(0, dims - len(q))))
                    slices = score_slices(both, q)
                    lo, hi = np.searchsorted(ids, qid), np.searchsorted(ids, qid, "right")
                    open_ = every
                    if lo < hi:
                        open_ = every.copy()
                        for i in range(lo, hi):
                            open_[i // 64] &= ~np.uint64(1 << (i % 64))
                    rows = select_top(slices, open_, k, len(ids))
                    shift = base * int(q.sum()) - most * int(-q[q < 0].sum())
                    for i in rows:
                        out[0].append(int(qid))
                        out[1].append(int(ids[i]))
                        out[2].append(shift + sum(((int(s[i // 64]) >> (int(i) % 64)) & 1) << w for w, s in enumerate(slices) if s is not None))
                yield pa.RecordBatch.from_pydict({"query_id": out[0], "vec_id": out[1], "score": out[2]},
                                                 schema=pa.schema([(c, pa.int64()) for c in ("query_id", "vec_id", "score")]))

    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, vector) of rows and queries -> query_id, rank, vec_id, score.

    The k highest integer inner products of each query, ties to the smaller id;
    all rows if there are fewer than k.  A row with the query's own id is no
    candidate.  Rows whose id or vector is null, or whose vector holds a null
    or non-finite component, take no part.  Vectors of unequal length are
    compared as if the shorter one went on with zeros.  A repeated id stands as
    often as the table holds it as a candidate, and once as a query (with its
    smallest vector).  An empty table gives an empty result.  Scores must fit a
    long.
    """
    def usable(df: DataFrame) -> DataFrame:
        return df.select(F.col("id").cast("long").alias("id"), quantised(F.col("vector")).alias("q")).filter("id is not null and q is not null")

    spark = vectors.sparkSession
    index = materialize(build_index(usable(vectors), block_rows), "bitsliced-index")
    packed = pack_queries(usable(queries).groupBy("id").agg(F.min("q").alias("q")))
    # index blocks are dealt to lanes, one a task; every query block goes to every lane
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.withColumn("lane", F.pmod(F.xxhash64("slot"), F.lit(lanes)).cast("int")).repartition(lanes, "lane")
    spread = packed.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).repartition(lanes, "lane")
    found = (dealt.join(spread, "lane").select("slot", "ids", "dims", "base", "bits", "slices", "qids", "qdims", "qs")
             .mapInArrow(_search(k), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
