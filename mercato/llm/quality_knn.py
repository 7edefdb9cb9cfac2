"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are its words, the shapes of its words (letter case, digits and
punctuation, repeats collapsed), pairs of neighbouring shapes and a few terms
for its structure (length, repeated words, repeated triples and lines), hashed
to ``DIMS`` columns.  A bounded sample of labelled texts gives the term
weights (inverse document frequency) and, by a randomised singular value
decomposition, ``RANK`` latent axes.  The labelled vectors are broadcast
(``SAMPLE`` x ``RANK`` floats: the bound does not grow with the corpus); every
document is projected and compared with all of them by blocked cosine
products, and its ``NEIGHBOURS`` most similar ones vote, weighted by a power
of their similarity.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import held_out, materialize, with_columns
from mercato.llm.runs import Recent, runs, worker_tables

DIMS = 1 << 13  # 13 bits: see _run_terms
RANK = 48
#: Most labelled texts that the classifier is fitted on and that vote.
SAMPLE = 4000
NEIGHBOURS = 15
POWER = 8
BLOCK = 256
THRESHOLD = 0.3

_repeats = regex.compile(r"(.)\1+").sub
_upper, _lower, _number = (regex.compile(p).sub for p in (r"\p{Lu}+", r"(?V1)[\p{L}--\p{Lu}]+", r"\p{N}+"))


def _column(term: str) -> int:
    return zlib.crc32(term.encode()) & (DIMS - 1)


def _run_terms(run: str) -> int:
    """Word column, shape column and 32 bits of the shape, packed in one number."""
    shape = "a" if run.isalpha() and run.islower() else _repeats(r"\1", _number("0", _lower("a", _upper("A", run))))[:12]
    word = run.lower().strip(".,;:!?\"'()[]{}#*$%&|<>-")
    return _column("w " + word) | _column("s " + shape) << 13 | zlib.crc32(shape.encode()) << 26


class Terms:
    """Weighted term columns of texts."""

    def __init__(self) -> None:
        self.runs = Recent(_run_terms, entries=150_000)
        self.named = Recent(_column, entries=10_000)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Columns (a structure term's may repeat another one's) and weights."""
        words = runs(text)
        n = len(words)
        packed = np.fromiter(map(self.runs.__getitem__, words), np.int64, n)
        shapes = packed >> 26
        pairs = (shapes[:-1] * 31 + shapes[1:]) % DIMS
        counts = np.bincount(np.concatenate((packed & (DIMS - 1), packed >> 13 & (DIMS - 1), pairs)), minlength=DIMS)
        columns = np.nonzero(counts)[0]
        structure = self.structure(text, packed)
        return (np.concatenate((columns, structure)),
                np.concatenate((np.sqrt(counts[columns] / max(n, 1)), np.ones(len(structure)))))

    def structure(self, text: str, packed: np.ndarray) -> np.ndarray:
        n = len(packed)
        share = lambda part, whole: round(10 * part / whole) if whole else 0
        lines = [x for x in text.split("\n") if x and not x.isspace()]
        triples = packed[:-2] * 1_000_003 + packed[1:-1] * 7919 + packed[2:]
        names = [
            f"length {round(2 * math.log2(n + 1))}",
            f"distinct {share(len(np.unique(packed)), n)}",
            f"next {share(int((packed[1:] == packed[:-1]).sum()), n)}",
            f"triples {share(len(triples) - len(np.unique(triples)), len(triples))}",
            f"lines {share(len(lines) - len(set(lines)), len(lines))}",
        ]
        return np.array([self.named["t " + x] for x in names])


@dataclass
class Model:
    """Term weights, latent axes (DIMS x rank), labelled vectors and their labels."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.zeros((len(texts), self.axes.shape[1]), np.float32)
        for i, (columns, weights) in enumerate(texts):
            w = (weights * self.idf[columns]).astype(np.float32)
            out[i] = (w / max(float(np.linalg.norm(w)), 1e-9)) @ self.axes[columns]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def vote(self, vectors: np.ndarray) -> np.ndarray:
        """Share of label 1 among each vector's nearest labelled ones, by similarity."""
        if not len(self.labels):
            return np.full(len(vectors), 0.5)
        out, k = [], min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(vectors), BLOCK):
            similar = vectors[at : at + BLOCK] @ self.vectors.T
            near = np.argpartition(similar, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(similar, near, 1), 1e-3).astype(np.float64) ** POWER
            out.append((weight * self.labels[near]).sum(1) / weight.sum(1))
        return np.concatenate(out) if out else np.zeros(0)


def fit(texts: list[tuple[np.ndarray, np.ndarray]], labels: list[int], rank: int = RANK) -> Model:
    """Latent axes of the labelled texts by a randomised singular value decomposition."""
    n = len(texts)
    present = np.zeros(DIMS)
    for columns, _ in texts:
        present[np.unique(columns)] += 1
    idf = np.log((n + 1) / (present + 1)) + 0.1
    x = np.zeros((n, DIMS), np.float32)
    for i, (columns, weights) in enumerate(texts):
        w = weights * idf[columns]
        np.add.at(x[i], columns, w / max(float(np.linalg.norm(w)), 1e-9))
    q = np.random.default_rng(0).standard_normal((DIMS, min(rank + 8, max(n, 1)))).astype(np.float32)
    for _ in range(3):
        q = np.linalg.qr(x.T @ (x @ q))[0] if n else q
    small = x @ q
    axes = (q @ np.linalg.svd(small, full_matrices=False)[2].T)[:, :rank] if n else q[:, :rank]
    model = Model(idf.astype(np.float32), np.ascontiguousarray(axes, np.float32), np.zeros((0, axes.shape[1]), np.float32), np.array(labels, np.float64))
    model.vectors = model.project(texts) if n else model.vectors
    return model


def terms() -> Terms:
    """One table of run columns a Python worker, let go when another operator's tables are made."""
    return worker_tables(("quality_terms",), Terms)


def sample_terms(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(id, text), (id, label) -> columns, weights, label of at most ``size`` labelled texts.

    The sample is the labels with the smallest id hashes, so it does not depend
    on the order of rows; only its ids are joined to the documents.  Of rows
    that share an id the text with the smallest hash is taken.
    """
    chosen = (labels.filter("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [terms().of(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["id"], b["label"], pa.array([c.astype("<i4").tobytes() for c, _ in found], pa.binary()),
                 pa.array([w.astype("<f4").tobytes() for _, w in found], pa.binary())], ["id", "label", "columns", "weights"])

    texts = docs.join(F.broadcast(chosen), "id").select("id", F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int").alias("label"))
    one = texts.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.mapInArrow(run, "id long, label int, columns binary, weights binary")


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model:
    rows = sorted(materialize(sample_terms(docs, labels, size), "quality-sample").collect())  # at most ``size`` texts' terms
    return fit([(np.frombuffer(r.columns, "<i4").astype(np.int64), np.frombuffer(r.weights, "<f4").astype(np.float64)) for r in rows], [r.label for r in rows])


def scored(rows: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, size: int = SAMPLE) -> DataFrame:
    """(id, text, any more), (id, label 0/1) -> + score; every document, whole texts.

    Only labels of ids outside fold ``fold`` of ``folds`` are learned from; a
    null id counts as held out; of repeated labels the larger one holds.  Null
    and empty texts are scored by their structure terms.  Without any label
    every score is 0.5.  Repeated rows are scored each.
    """
    learn = labels.select(F.col("id").cast("long").alias("id"), "label").filter(~held_out(F.col("id"), folds, fold))
    docs = rows.select(F.col("id").cast("long").alias("id"), "text")
    model = rows.sparkSession.sparkContext.broadcast(train(docs, learn, size))

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        vectors = model.value.project([terms().of(t or "") for t in b["text"].to_pylist()])
        return [pa.array(model.value.vote(vectors), pa.float64())]

    return with_columns(rows, "score double", make)


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, size: int = SAMPLE) -> DataFrame:
    """(id, text), (id, label 0/1) -> doc_id, held_out, score, predicted; see ``scored``.  Extra columns are left out."""
    return (scored(docs.select(F.col("id").cast("long").alias("id"), "text"), labels, folds, fold, size)
            .select(F.col("id").alias("doc_id"), held_out(F.col("id"), folds, fold).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
