"""Quality, language, near duplicates, repeats: against brute force and edge cases."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mercato.llm import jaccard_join, language_id, quality_knn, quality_rules, suffix_dedup
from mercato.llm.common import held_out, python_tasks
from mercato.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def renamed(docs, **more):
    """doc_id -> id, source -> host; the columns that bore those names get others."""
    return docs.withColumnRenamed("id", "other").withColumnRenamed("doc_id", "id").withColumnsRenamed({"source": "host", **more})


# --- quality rules -----------------------------------------------------------------------------------------

def brute_rules(rows, min_docs, share):
    words = lambda t: WORD.findall(t or "")
    norm = lambda x: " ".join(words(x.lower()))
    seen, contents = collections.defaultdict(set), collections.defaultdict(set)
    for _, t, _, host in rows:
        contents[host].add(t)
        for x in (t or "").split("\n"):
            if words(x):
                seen[host, norm(x)].add(t)
    out = []
    for i, t, _, host in rows:
        w, lines = words(t), [x for x in (t or "").split("\n") if words(x)]
        count = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        hit = {j for k in range(len(w) - 2) if count[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
        gone = sum(len(words(x)) for x in lines if len(seen[host, norm(x)]) > max(min_docs, share * len(contents[host])))
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        left = len(w) - gone
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit),
                    failed, not failed and 2 * left >= len(w), gone))
    return out


def test_quality_rules(spark, docs_of, prose):
    boiler = "\n".join(f"Subscribe TO  our {prose(k, 3)} \t now" for k in range(8))
    rows = [(i, f"{prose(i, 70)}\n{boiler}\n{prose(1000 + i, 20)}", "en", "a" if i % 3 else None) for i in range(60)]
    rows += [(100 + i, "\n".join([boiler.lower(), prose(200 + i, 40)]), "en", "a") for i in range(3)]  # depleted
    rows += [(200, "x y z " * 40, "en", "b"), (201, prose(5, 55) + "\n\n" + prose(6, 3) + "\n" + prose(6, 3), "en", "b"), (202, None, "en", "b"),
             (203, "", "en", "b"), (204, " \n\t\x0b \n", "en", "b"), (205, "é🙂 #$ <b>\r\na\x85b\xa0c", "en", "b")]
    rows += [(300, rows[0][1], "en", "c")] * 40 + [(None, rows[1][1], "en", "a"), (0, prose(0, 60), "en", "a")]  # repeated rows; an id twice
    got = quality_rules.judge(renamed(docs_of(rows)), min_docs=10, share=0.01).collect()
    expected = brute_rules(rows, 10, 0.01)
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    by = {r.doc_id: r for r in got}
    assert not by[100].kept and not by[100].base_failed and by[4].kept and by[300].kept  # copies alone make no line frequent
    assert quality_rules.judge(renamed(docs_of(rows).limit(0))).count() == 0


def test_quality_rules_are_native(spark, docs_of):
    plan = quality_rules.judge(renamed(docs_of([(1, "a b c", "en", "h")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- quality classifier ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def rated(docs_of, spark, prose):
    """Clean prose and junk, with labels for two thirds."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        text = prose(i, rng.randint(20, 200))
        if not good:
            kind = i % 3
            text = (" ".join(w + "***" for w in text.split()) if kind == 0 else text.upper().replace(" ", "!! ") if kind == 1
                    else " ".join(w for w in text.split() for _ in range(6)))
        rows.append((i, text, "en", "s"))
        if i % 3:
            labels.append((i, int(good)))
    odd = [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, " \n ", "en", "s"), (1003, "word " * 30000, "en", "s"), (None, "no id", None, None), (7, rows[7][1], "en", "s")]
    return docs_of(rows + odd), spark.createDataFrame([*labels, (None, 1), (5000, 0), (4, None)], "id long, label int"), {i: (t, q) for (i, t, _, _), q in zip(rows, [None] * 400, strict=True)}


def test_quality_neighbours(spark, rated):
    python_tasks(spark)
    docs, labels, _ = rated
    got = quality_knn.score(renamed(docs), labels).collect()
    truth = {r.id: r.label for r in labels.collect()}
    assert len(got) == 406 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    hidden = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert len(hidden) > 30 and np.mean([a == b for a, b in hidden]) > 0.9
    assert len({round(r.score, 9) for r in got if r.doc_id == 7}) == 1
    assert all(r.held_out for r in got if r.doc_id is None)
    none = quality_knn.score(renamed(docs), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_knn.score(renamed(docs).limit(0), labels).count() == 0


def test_vote_is_the_blocked_cosine_vote():
    rng = np.random.default_rng(0)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    refs, labels, queries = unit(rng.normal(size=(100, 8))), rng.integers(0, 2, 100).astype(float), unit(rng.normal(size=(600, 8)))
    model = quality_knn.Model(np.ones(1, np.float32), np.ones((1, 8), np.float32), refs, labels)
    expected = []
    for q in queries:
        s = refs @ q
        near = np.argsort(-s)[: quality_knn.NEIGHBOURS]
        w = np.maximum(s[near], 1e-3).astype(float) ** quality_knn.POWER
        expected.append((w * labels[near]).sum() / w.sum())
    assert np.allclose(model.vote(queries), expected, atol=1e-5)


def test_the_sample_has_one_row_an_id(spark, docs_of):
    python_tasks(spark)
    docs = renamed(docs_of([(7, f"hot text {n}", "en", "s") for n in range(200)] + [(i, f"text {i}", "en", "s") for i in range(8, 12)]))
    labels = spark.createDataFrame([(i, 1) for i in range(7, 12)], "id long, label int")
    got = [quality_knn.sample_terms(d, labels, 5).collect() for d in (docs.repartition(3), docs.repartition(7))]
    assert sorted(r.id for r in got[0]) == [7, 8, 9, 10, 11] and sorted(got[0]) == sorted(got[1])


# --- language ----------------------------------------------------------------------------------------------

P = pytest.importorskip("public_tokenizers")
PIECES = P.path("piece_bpe_32k.model")


def test_forward_sums_all_segmentations():
    vocab = language_id.vocabulary(PIECES)
    p = np.random.default_rng(0).random((vocab.size + 1, 3)) / vocab.size

    def brute(word):
        if not word:
            return np.ones(3)
        return sum(p[piece] * brute(word[j:]) for i, j, piece in vocab.edges(word) if i == 0)

    words = ["▁the", "▁schön", "▁日本x", "▁a🙂b", "▁"]
    total = language_id.Lattice(words, vocab).total(p)
    for w, t in zip(words, total, strict=True):
        assert np.allclose(t, np.log(brute(w))) and np.allclose(language_id.log_total_long(w, vocab, p), t)
    assert language_id.log_total_long("▁" + "ab" * 5000, vocab, p).max() < 0


def test_expected_counts_add_up_to_each_words_segmentations():
    vocab = language_id.vocabulary(PIECES)
    p = np.full((vocab.size + 1, 2), 1 / vocab.size)
    expected = language_id.Lattice(["▁x"], vocab).expected(p, np.array([[3.0, 5.0]]))
    lengths = np.zeros(vocab.size + 1)
    for _, _, piece in vocab.edges("▁x"):
        lengths[piece] = next((len(k) for k, v in vocab.ids.items() if v == piece), 1)
    assert np.allclose((expected * lengths[:, None]).sum(0), [6.0, 10.0])  # every segmentation covers both characters


def test_long_runs_are_summed_and_learned_like_short_ones():
    vocab = language_id.vocabulary(PIECES)
    p = np.random.default_rng(1).random((vocab.size + 1, 3)) / vocab.size
    words, counts = ["▁the", "▁schön", "▁日本x", "▁a🙂b", "▁"], np.arange(15.0).reshape(5, 3)
    lattice = language_id.Lattice(words, vocab)
    assert np.allclose(lattice.log_total(p), lattice.total(p)) and np.allclose(lattice.expected_long(p, counts), lattice.expected(p, counts))
    # half of a run is far likelier in one language, the longer half in the other: no sum may vanish on the way
    p = np.full((vocab.size + 1, 2), 1e-3)
    p[vocab.ids["a"]], p[vocab.ids["x"]] = [1e-2, 1e-9], [1e-9, 1e-2]
    half = language_id.log_total_long("▁" + "a" * 500 + "x" * 2000, vocab, p)
    assert half[1] > half[0] and np.isfinite(half).all() and half[1] < -1000
    expected = language_id.Lattice(["▁" + "ab" * 3000], vocab).expected_long(p, np.ones((1, 2)))
    lengths = np.ones(vocab.size + 1)
    for k, v in vocab.ids.items():
        lengths[v] = len(k)
    assert np.allclose((expected * lengths[:, None]).sum(0), 6001)
    groups = [*language_id.grouped(["x" * n for n in (3, 100_000, 300_000, 5, 400_000)], 2)]
    assert [[len(w) for w in g] for g in groups] == [[3, 5], [100_000], [300_000], [400_000]]


def test_languages_without_spaces(spark, docs_of):
    python_tasks(spark)
    rng = random.Random(4)
    signs = {"ja": "のにはをたがでて", "zh": "的是不了在人有我"}
    make = lambda lang: "".join(rng.choices(signs[lang] + "一大中", k=rng.randint(50, 300)))
    truth = {i: "zh" if i % 3 else "ja" for i in range(240)}  # the prior is for zh
    docs = renamed(docs_of([(i, make(lang), lang, "s") for i, lang in truth.items()]))
    got = language_id.identify(docs, PIECES).collect()
    assert len(got) == 240 and any(r.held_out for r in got)
    assert all(r.lang_pred == truth[r.doc_id] and r.score > 0.9 for r in got)


def test_language(spark, docs_of):
    python_tasks(spark)
    rng = random.Random(2)
    sounds = {"aa": ["the", "ing", "wh", "er"], "bb": ["sch", "ung", "ei", "ö"], "cc": ["ción", "ado", "que", "ñ"]}
    make = lambda lang, n: " ".join("".join(rng.choices(sounds[lang], k=3)) for _ in range(n))
    rows = [(i, make(lang := "aabbcc"[2 * (i % 3) :][:2], rng.randint(5, 60)), lang if i % 11 else None, "s") for i in range(300)]
    odd = [(900, None, "aa", "s"), (901, "", "aa", "s"), (902, "12 !? --", "aa", "s"), (903, make("bb", 3) + " " + "x" * 5000, "bb", "s"), (None, make("cc", 20), "cc", "s")]
    docs = renamed(docs_of(rows + odd))
    got = language_id.identify(docs, PIECES).collect()
    assert len(got) == 305
    truth = {i: "aabbcc"[2 * (i % 3) :][:2] for i in range(300)}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.doc_id in truth and r.held_out]) > 0.95
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (900, 901, 902))
    assert all(0 <= r.score <= 1 for r in got)
    nothing = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")), PIECES).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language_id.identify(docs.limit(0), PIECES).count() == 0


def test_held_out_is_crc32_of_the_ids_text(spark):
    import zlib
    got = spark.range(50).select("id", held_out(F.col("id"), 5, 0).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


# --- near duplicates ---------------------------------------------------------------------------------------

def brute_join(rows):
    def shingles(t):
        w = WORD.findall(t or "")
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    by = collections.defaultdict(list)
    for i, t, *_ in rows:
        by[shingles(t)].append(i)
    out, alone = {}, by.pop(frozenset(), [])
    nodes = {s: min(v) for s, v in by.items()}
    links, label = collections.Counter(), {n: n for n in nodes.values()}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(nodes, 2):
        if 5 * len(a & b) >= 4 * len(a | b):
            x, y = find(nodes[a]), find(nodes[b])
            label[max(x, y)] = min(x, y)
            links[a] += 1
            links[b] += 1
    for s, ids in by.items():
        for i in ids:
            out[i] = (find(nodes[s]), nodes[s], len(ids), links[s])
    return out | {i: (i, i, 1, 0) for i in alone}


@pytest.fixture(scope="module")
def copies(prose):
    rng = random.Random(9)
    rows = []

    def add(text):
        rows.append((len(rows), text, "en", "s"))

    for g in range(12):
        base = prose(g, rng.randint(30, 150)).split()
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = prose(rng.random(), 1)
            add(" ".join(w))
            if rng.random() < 0.3:
                add(" \n".join(w))
    for t in (None, "", " \n", "one", "one", "one two three four", "a b c d e"):
        add(t)
    for n in range(60):  # a chain: neighbours are near, ends are not
        add(" ".join(prose("chain", 200).split()[2 * n : 2 * n + 60]))
    return rows


def test_jaccard_join(spark, docs_of, copies):
    python_tasks(spark)
    got = jaccard_join.join(renamed(docs_of(copies)).repartition(3)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute_join(copies) and len(got) == len(copies)


def test_jaccard_join_in_small_blocks(spark, docs_of, copies, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET_BLOCK", 3)
    monkeypatch.setattr(jaccard_join, "TEXT_BLOCK", 4)
    got = jaccard_join.join(renamed(docs_of(copies))).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute_join(copies)


def test_jaccard_join_edge_cases(spark, docs_of, prose):
    t = prose(1, 50)
    got = jaccard_join.join(renamed(docs_of([(5, t, "en", "s"), (5, t, "en", "s"), (9, t, "en", "s"), (None, t, "en", "s")]))).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(5, 5, 5, 3, 0), (5, 5, 5, 3, 0), (9, 5, 5, 3, 0), (None, None, None, 1, 0)]))
    assert jaccard_join.join(renamed(docs_of([]))).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    keep = jaccard_join.least_matches()
    assert list(keep) == [16, 32, 48, 64] and all(m < 0.8 * n for n, m in keep.items()) and keep[64] > 25
    from math import comb
    for n, m in keep.items():  # a pair of similarity 0.8 has m matches or more, nearly always
        assert sum(comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(m)) < 1e-6


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(100)] + [(500, 300), (300, 400), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert got == {k: 0 for k in range(101)} | {k: 300 for k in (300, 400, 500)}


# --- repeated strings --------------------------------------------------------------------------------------

def brute_repeats(rows):
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    count = collections.Counter(b[p : p + 200] for _, b in data for p in range(len(b) - 199))
    out = []
    for i, b in data:
        covered = np.zeros(len(b), bool)
        for p in range(len(b) - 199):
            if count[b[p : p + 200]] > 1:
                covered[p : p + 200] = True
        kept = np.frombuffer(b, np.uint8)[~covered].tobytes()
        spans = int((np.diff(np.concatenate(([0], covered.astype(np.int8)))) == 1).sum())
        out.append((i, len(b), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def passages(prose):
    rng = random.Random(3)
    shared = [prose(f"p{k}", 60) for k in range(4)]
    rows = []
    for i in range(60):
        parts = [prose(i * 7 + k, rng.randint(1, 60)) for k in range(rng.randint(1, 3))]
        if rng.random() < 0.7:
            p = rng.choice(shared)
            parts.insert(rng.randrange(len(parts) + 1), p[rng.randrange(0, 60) : len(p) - rng.randrange(0, 60)])
        rows.append((i, "\n".join(parts), "en", "s"))
    exact = "x" * 50 + prose("edge", 40)[:149] + "é"
    rows += [(100, "q" + exact[:200] + "1", "en", "s"), (101, "w" + exact[:200] + "2", "en", "s"), (102, "ab" * 400, "en", "s"),
             (103, "z" * 1000, "en", "s"), (104, prose(1, 50) + "z" * 199, "en", "s"), (105, "日本語" * 100 + prose(8, 30), "en", "s"),
             (106, None, "en", "s"), (107, "", "en", "s"), (108, rows[3][1], "en", "s"), (109, rows[3][1][:190], "en", "s")]
    return rows


@pytest.mark.parametrize("crowded", [1, 3, 2000])
def test_suffix_dedup(spark, docs_of, passages, crowded, monkeypatch):
    python_tasks(spark)
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    got = suffix_dedup.dedup(renamed(docs_of(passages)).select("id", "text").repartition(4))
    got = got.select("id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(passages)


def test_suffix_dedup_repeated_rows_and_long_text(spark, docs_of, prose, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 500)
    monkeypatch.setattr(suffix_dedup, "SORTED_AT_ONCE", 50)
    rows = [(1, prose(1, 300), "en", "s"), (1, prose(1, 300), "en", "s"), (2, prose(2, 3000), "en", "s"), (3, prose(2, 900)[2000:], "en", "s"),
            (None, prose(3, 100), "en", "s"), (1, prose(4, 100), "en", "s")]
    got = suffix_dedup.dedup(renamed(docs_of(rows)).select("id", "text"))
    got = got.select("id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(rows)
    assert suffix_dedup.dedup(renamed(docs_of([])).select("id", "text")).count() == 0


def test_equal_windows_is_a_sort_by_all_tokens():
    rng = np.random.default_rng(5)
    windows = rng.integers(0, 2, (400, 200), dtype=np.uint8)
    windows[:, :195] = windows[0, :195]
    group = rng.integers(0, 3, 400)
    count = collections.Counter((g, w.tobytes()) for g, w in zip(group, windows, strict=True))
    expected = [k for k in range(400) if count[group[k], windows[k].tobytes()] > 1]
    assert sorted(suffix_dedup.equal_windows(group, windows)) == expected


def test_whole_spans_are_merged_by_document_and_batch():
    rng = random.Random(9)
    rows = []
    for batch in range(3):
        for _ in range(40):
            places = [(rng.choice([None, 0, 1, -5]), rng.randint(0, 1), rng.randint(0, 5000)) for _ in range(rng.randint(1, 3))]
            rows.append({"batch": batch, "n": rng.randint(1, 90), **dict(zip(("ids", "hashes", "firsts"), map(list, zip(*places, strict=True)), strict=True))})
    schema = pa.schema([("batch", pa.int64()), ("n", pa.int64()), *((c, pa.list_(pa.int64())) for c in ("ids", "hashes", "firsts"))])
    whole = pa.Table.from_pylist(rows, schema)
    got = [r for b in suffix_dedup._whole_spans(iter(whole.to_batches(max_chunksize=17))) for r in b.to_pylist()]
    expected = collections.defaultdict(list)
    for r in rows:
        for place in zip(r["ids"], r["hashes"], r["firsts"], strict=True):
            expected[r["batch"], place[0], place[1]].append({"start": place[2], "stop": place[2] + r["n"] - 1 + suffix_dedup.LENGTH})
    want = [(i, h, suffix_dedup.merged(spans)) for (_, i, h), spans in expected.items()]
    assert sorted(((r["id"], r["hash"], [(x["start"], x["stop"]) for x in r["spans"]]) for r in got), key=str) == sorted(want, key=str)


def test_suffix_dedup_with_clashing_columns(spark, docs_of, prose):
    shared = prose(77, 80)
    rows = [(1, prose(1, 30) + " " + shared, "en", "s"), (2, shared + " " + prose(2, 30), "en", "s"), (3, prose(3, 40), "en", "s"), (None, None, "en", "s")]
    rows += [rows[0]] * 20 + [(1, prose(4, 50), "en", "s")]     # a row that stands often, and its id with another text
    names = ("hash", "spans", "n_removed", "kept", "n_bytes", "n_spans", "more", "key", "whole", "ids", "firsts")
    docs = renamed(docs_of(rows, extra=names))
    got = suffix_dedup.dedup(docs)
    assert set(docs.columns) <= set(got.columns) and len(got.columns) == len(set(got.columns))
    found = got.collect()
    assert len(found) == len(rows) and {(r["hash"], r["spans"], r["more"], r["whole"]) for r in found} == {("x",) * 4}
    data = [(t or "").encode() for _, t, _, _ in rows]
    expected = brute_removed(data)
    assert sorted((str(r["id"]), r["n_bytes"], r["n_removed"]) for r in found) == sorted((str(i), len(d), n) for (i, *_), d, n in zip(rows, data, expected, strict=True))


def brute_removed(data):
    """Bytes of each text that a 200-byte string covers which starts anywhere else too."""
    from collections import Counter
    seen = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - 199):
            if seen[d[i : i + 200]] > 1:
                gone[i : i + 200] = b"\x01" * 200
        out.append(sum(gone))
    return out


def test_empty_tables_and_clashing_columns(spark, docs_of):
    names = ("node", "key", "sig", "bucket", "class_id", "score", "lang_pred", "line", "words", "content", "nth", "n_words")
    some = renamed(docs_of([(1, "one two three four five six", "en", "s"), (None, None, None, None)], extra=names))
    path = P.path("piece_bpe_32k.model")
    hosted = some.withColumnRenamed("source", "host")
    for make, docs in ((jaccard_join.join, some), (lambda d: language_id.identify(d, path), some), (quality_rules.judge, hosted)):
        assert make(docs.limit(0)).count() == 0
        assert make(docs).count() == 2
