"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
The probability of a text is the sum over all its segmentations into pieces; a
forward algorithm sums them.  No piece spans white space, so a text's sum is
the product over its runs of characters, and each distinct run is summed once
while it stays in a bounded table; runs that are new in a batch are summed
together, one array step for each end position and piece length.

The probabilities are learned by expectation maximisation: expected piece
counts over all segmentations (forward and backward) of a bounded sample of
labelled texts, added up by Spark; only languages x vocabulary sums reach the
driver.  Runs of ``LONGEST`` characters or more, which are nearly all of a text
written without spaces, are summed and learned from whole as well: in
logarithms, so that no sum vanishes, and in groups of bounded size.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import held_out, materialize
from mercato.llm.runs import runs

#: About this many labelled texts are learned from, for each language.
SAMPLE = 2000
ROUNDS = 2
#: Pseudo-counts of a language's pieces: by the pooled probabilities, and even.
POOLED, EVEN = 500.0, 50.0
#: Probability of a character that no piece holds, alike in all languages.
UNKNOWN = 1e-6
WORD_START = "▁"
CACHE_ENTRIES = 400_000
#: Runs of so many characters are summed in logarithms.
LONGEST = 40
#: Sums (positions x languages) of long runs that are held at once; a single run can need more.
HELD = 1 << 19


class Vocabulary:
    """Pieces of a sentencepiece model, without control, byte and unused ones."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids = {model.id_to_piece(i): i for i in range(model.get_piece_size())
                    if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
        self.size = model.get_piece_size()
        self.prefixes = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        nodes = {p: n for n, p in enumerate(sorted(self.prefixes), 1)} | {"": 0}  # a trie: (node, character) -> node
        steps = sorted((nodes[p[:-1]] << 21 | ord(p[-1]), n) for p, n in nodes.items() if p)
        self.keys, self.children = (np.array(x, np.int64) for x in zip(*steps, strict=True))
        self.piece = np.full(len(nodes), -1, np.int64)
        for p, i in self.ids.items():
            self.piece[nodes[p]] = i

    def edges(self, word: str) -> Iterator[tuple[int, int, int]]:
        """(start, end, piece) of every piece in a word; size is the piece of an unknown character."""
        for i in range(len(word)):
            known = False
            for j in range(i + 1, len(word) + 1):
                piece = word[i:j]
                if piece not in self.prefixes:
                    break
                if (at := self.ids.get(piece)) is not None:
                    known = known or j == i + 1
                    yield i, j, at
            if not known:
                yield i, i + 1, self.size


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def marked(run: str) -> str:
    return WORD_START + run.lower()


class Lattice:
    """All segmentations of many words at once: edges grouped by end and length."""

    def __init__(self, words: list[str], vocab: Vocabulary) -> None:
        self.lengths = np.array(list(map(len, words)), np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), self.lengths)
        at = np.arange(len(chars)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        left = self.lengths[word] - at
        start, node, found = np.arange(len(chars)), np.zeros(len(chars), np.int64), []
        for size in range(1, int(self.lengths.max(initial=0)) + 1):  # all starts walk the trie together
            keep = left[start] >= size
            start, node = start[keep], node[keep]
            key = node << 21 | chars[start + size - 1]
            place = np.minimum(np.searchsorted(vocab.keys, key), len(vocab.keys) - 1)
            keep = vocab.keys[place] == key
            start, node = start[keep], vocab.children[place[keep]]
            piece = vocab.piece[node]
            if size == 1:
                known = np.zeros(len(chars), bool)
                known[start[piece >= 0]] = True
                odd = np.nonzero(~known)[0]
                found.append((odd, np.full(len(odd), vocab.size), 1))
            found.append((start[piece >= 0], piece[piece >= 0], size))
            if not len(start):
                break
        self.ends, self.sizes, self.cuts = (np.zeros(0, np.int64) for _ in range(3))
        if found:
            starts, pieces = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            sizes = np.repeat([f[2] for f in found], [len(f[0]) for f in found])
            group = (at[starts] + sizes) << 16 | sizes
            order = np.argsort(group, kind="stable")
            self.cuts = np.nonzero(np.diff(group[order], prepend=-1))[0]
            self.ends, self.sizes = np.divmod(group[order[self.cuts]], 1 << 16)
            self.words, self.pieces = word[starts[order]], pieces[order]

    def steps(self, backward: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(end, size, words, pieces) by end and size; a word is in a step once, and in all of size 1 up to its length."""
        many = range(len(self.cuts))
        for k in reversed(many) if backward else many:
            at = slice(self.cuts[k], self.cuts[k + 1] if k + 1 < len(self.cuts) else None)
            yield int(self.ends[k]), int(self.sizes[k]), self.words[at], self.pieces[at]

    def forward(self, p: np.ndarray) -> np.ndarray:
        """p: (pieces, languages) -> (words, positions, languages)."""
        a = np.zeros((len(self.lengths), int(self.lengths.max(initial=0)) + 1, p.shape[1]))
        a[:, 0] = 1
        for j, size, ws, ps in self.steps():
            a[ws, j] += a[ws, j - size] * p[ps]
        return a

    def total(self, p: np.ndarray) -> np.ndarray:
        """Log probability of each word, in each language."""
        a = self.forward(p)
        return np.log(np.maximum(a[np.arange(len(a)), self.lengths], 1e-300))

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces; counts: of each word, in each language."""
        a, b = self.forward(p), np.zeros((len(self.lengths), int(self.lengths.max(initial=0)) + 1, p.shape[1]))
        rows = np.arange(len(a))
        b[rows, self.lengths] = 1
        weight = counts / np.maximum(a[rows, self.lengths], 1e-300)
        out = np.zeros(p.shape)
        for j, size, ws, ps in self.steps(backward=True):
            through = p[ps] * b[ws, j]
            np.add.at(out, ps, a[ws, j - size] * through * weight[ws])
            b[ws, j - size] += through
        return out


    def log_forward(self, p: np.ndarray) -> np.ndarray:
        """Logarithms of ``forward``, for words of any length; each language is scaled by itself."""
        a = np.zeros((len(self.lengths), int(self.lengths.max(initial=0)) + 1, p.shape[1]))
        for j, steps in groupby(self.steps(), key=lambda s: s[0]):
            _, _, rows, ps = next(steps)  # the step of size 1: every word that reaches j
            through = np.zeros((len(a), p.shape[1]))
            through[rows] = p[ps]
            for _, size, ws, ps in steps:
                through[ws] += np.exp(a[ws, j - size] - a[ws, j - 1]) * p[ps]
            a[rows, j] = a[rows, j - 1] + np.log(through[rows])
        return a

    def log_total(self, p: np.ndarray) -> np.ndarray:
        return self.log_forward(p)[np.arange(len(self.lengths)), self.lengths]

    def expected_long(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """``expected`` for words of any length: backward go the probabilities that a cut is at a position."""
        a = self.log_forward(p)
        cut, out = np.zeros(a.shape), np.zeros(p.shape)
        cut[np.arange(len(a)), self.lengths] = 1
        for j, size, ws, ps in self.steps(backward=True):
            used = np.exp(a[ws, j - size] - a[ws, j]) * p[ps] * cut[ws, j]
            np.add.at(out, ps, used * counts[ws])
            cut[ws, j - size] += used
        return out


def grouped(words: list[str], languages: int) -> Iterator[list[str]]:
    """Words of similar length together, at most ``HELD`` sums in a group of several."""
    group: list[str] = []
    for w in sorted(words, key=lambda w: (len(w), w)):
        if group and (len(group) + 1) * (len(w) + 2) * languages > HELD:
            yield group
            group = []
        group.append(w)
    if group:
        yield group


def log_total_long(word: str, vocab: Vocabulary, p: np.ndarray) -> np.ndarray:
    """Log probability of one word of any length."""
    return Lattice([word], vocab).log_total(p)[0]


class Scorer:
    """Log probabilities of texts under each language."""

    def __init__(self, vocab: Vocabulary, p: np.ndarray) -> None:
        self.vocab, self.p = vocab, p
        self.rows: dict[str, int] = {}
        self.table = np.zeros((CACHE_ENTRIES, p.shape[1]))

    def score(self, texts: list[str]) -> np.ndarray:
        parts = [runs(t) for t in texts]
        distinct = set().union(*parts)
        new = [r for r in distinct if r not in self.rows and len(r) < LONGEST]
        if len(self.rows) + len(new) > CACHE_ENTRIES:
            self.rows, new = {}, [r for r in distinct if len(r) < LONGEST]
            self.table = np.zeros((max(CACHE_ENTRIES, len(new)), self.p.shape[1]))
        if new:
            at = len(self.rows)
            self.table[at : at + len(new)] = Lattice([marked(r) for r in new], self.vocab).total(self.p)
            self.rows.update(zip(new, range(at, at + len(new)), strict=True))
        long = {r: total for group in grouped([r for r in distinct if len(r) >= LONGEST], self.p.shape[1])
                for r, total in zip(group, Lattice([marked(r) for r in group], self.vocab).log_total(self.p), strict=True)}
        out = np.zeros((len(texts), self.p.shape[1]))
        for n, part in enumerate(parts):
            for r in (x for x in part if x in long) if long else ():
                out[n] += long[r]
            short = [x for x in part if x not in long] if long else part
            if short:
                out[n] += self.table[np.fromiter(map(self.rows.__getitem__, short), np.int64, len(short))].sum(0)
        return out


def _expectations(path: str, languages: list[str], p: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, place = vocabulary(path), {lang: k for k, lang in enumerate(languages)}
        for b in batches:
            counts: dict[str, Counter] = defaultdict(Counter)
            for text, lang in zip(b["text"].to_pylist(), b["lang"].to_pylist(), strict=True):
                counts[lang].update(runs(text))
            words = sorted(w for w in set().union(*counts.values()) if len(w) < LONGEST)
            weight = np.zeros((len(words), len(languages)))
            for lang, of in counts.items():
                weight[:, place[lang]] = [of[w] for w in words]
            expected = Lattice([marked(w) for w in words], vocab).expected(p, weight)
            for lang, of in counts.items():
                k = place[lang]
                for group in grouped([w for w in of if len(w) >= LONGEST], 1):
                    times = np.array([[of[w]] for w in group], np.float64)
                    expected[:, [k]] += Lattice([marked(w) for w in group], vocab).expected_long(p[:, [k]], times)
            piece, lang = np.nonzero(expected)
            yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(expected[piece, lang], pa.float64())],
                                             ["piece", "place", "n"])

    return run


def learn(labelled: DataFrame, path: str, sample: int = SAMPLE, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(id, text, lang) -> languages, (pieces + 1, languages) probabilities, log priors.

    A language's texts are sampled by a hash of their ids, at a rate that gives
    about ``sample`` of them; one row a language reaches the driver for that.
    """
    size = vocabulary(path).size
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((size + 1, 0)), np.zeros(0)
    rate = F.element_at(F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, min(1.0, sample / v))]), F.col("lang"))
    chosen = materialize(labelled.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < rate * (1 << 30)), "language-sample")
    p = np.full((size + 1, len(languages)), 1.0 / size)
    p[size] = UNKNOWN
    for _ in range(rounds):
        sums = (chosen.mapInArrow(_expectations(path, languages, p), "piece int, place int, n double")
                .groupBy("piece", "place").agg(F.sum("n").alias("n")).toArrow())  # languages x vocabulary at most
        counts = np.zeros((size + 1, len(languages)))
        counts[sums["piece"].to_numpy(), sums["place"].to_numpy()] = sums["n"].to_numpy()
        counts = counts[:size]
        pooled = counts.sum(1, keepdims=True) / max(counts.sum(), 1e-9)
        counts = counts + POOLED * pooled + EVEN / size
        p = np.vstack((counts / counts.sum(0), np.full((1, len(languages)), UNKNOWN)))
    n = np.array([sizes[x] for x in languages], np.float64)
    return languages, p, np.log(n / n.sum())


def identify(docs: DataFrame, path: str, folds: int = 4, fold: int = 2, sample: int = SAMPLE, rounds: int = ROUNDS) -> DataFrame:
    """(id, text, lang) -> doc_id, held_out, lang_pred, score; every document, whole texts.

    Learned from texts with a language whose id is outside fold ``fold`` of
    ``folds`` (a null id counts as held out).  ``score`` is the posterior
    probability of the predicted language; equal ones go to the first language
    by name.  A null text, one without a letter, and any text if nothing could
    be learned give ``und`` and 0.  Repeated rows are scored each.  Texts are
    scored whole; a run without spaces holds a sum for each of its characters
    and languages.  An empty table gives an empty result.  Other columns,
    whatever their names, are left out.
    """
    docs = docs.select(F.col("id").cast("long").alias("id"), "text", "lang")
    learned = docs.filter(~held_out(F.col("id"), folds, fold) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    languages, p, prior = learn(learned, path, sample, rounds)
    model = docs.sparkSession.sparkContext.broadcast((languages, p, prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, p, prior = model.value
        scorer = Scorer(vocabulary(path), p)
        for b in batches:
            texts = [t or "" for t in b["text"].to_pylist()]
            lettered = [bool(languages) and any(map(str.isalpha, t)) for t in texts]
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            if any(lettered):
                total = scorer.score([t if ok else "" for t, ok in zip(texts, lettered, strict=True)]) + prior
                best = total.argmax(1)
                share = 1 / np.exp(np.minimum(total - total.max(1, keepdims=True), 0)).sum(1)
                for n, ok in enumerate(lettered):
                    if ok:
                        pred[n], score[n] = languages[best[n]], float(share[n])
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return (docs.select("id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
            .select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "lang_pred", "score"))
