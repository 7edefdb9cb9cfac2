"""Every stage of the corpus pipeline on its own input, and the whole run, against brute force."""

import collections
import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

import corpus_pipeline as C  # noqa: E402
from mercato.llm import byte_bpe, quality_knn  # noqa: E402
from tests.llm.test_text_operators import brute_join, brute_repeats  # noqa: E402


@pytest.fixture(scope="module")
def corpus(spark, docs_of, prose, tmp_path_factory):
    """Documents with copies, near copies, shared passages, junk, nulls and repeated rows; labels of some."""
    rng = random.Random(6)
    rows, labels = [], []
    passage = prose("shared", 80)
    for i in range(150):
        text = prose(i, rng.randint(30, 120))
        if i % 5 == 0:
            text = " ".join(w + "***" for w in text.split())
        if i % 7 == 1:
            text += "\n" + passage
        rows.append((i, text, "en", ["a", "b", "c", None][i % 4] if i % 3 else "hot"))
        if i % 3:
            labels.append((i, int(i % 5 > 0), 0))
    for i in range(150, 170):
        words = rows[(i - 150) // 4 * 7 + 2][1].split()
        if i % 4:
            words[3] = "changed"
        rows.append((i, " ".join(words), "en", "a"))
    rows += [(200, None, None, None), (201, "", "en", "a"), (202, " \n", "en", "a"), (203, "x " * 5000, "en", "b"),
             (None, prose("n", 60), "en", "a"), (None, prose("n", 60), "en", "a"), (2, rows[2][1], "en", rows[2][3])]
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = docs_of(rows, extra=("id", "doc", "hash", "bucket", "size"))
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return spark.read.parquet(f"{path}/documents.parquet"), path


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


def triples(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


def test_stages_and_columns(spark, corpus):
    docs, path = corpus
    assert [n for n, _ in C.STAGES] == ["quality classifier", "n-gram Jaccard join", "suffix-array dedup",
                                        "mixing sources to target weights", "byte-level BPE encoding and decoding"]
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        assert stage(spark, docs.limit(0), path).count() == 0
    assert C.STAGES[-1][1](spark, docs.limit(0), path).count() == 0


def test_quality_stage_drops_what_the_operator_rejects(spark, corpus):
    docs, path = corpus
    labels = spark.read.parquet(f"{path}/labels.parquet").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    scored = quality_knn.score(docs.select(F.col("doc_id").alias("id"), "text"), labels).collect()
    kept = C.quality_classifier(spark, docs, path)
    assert kept.count() == sum(r.predicted for r in scored)
    left = {r.doc_id for r in kept.collect()}
    assert len([i for i in range(150) if i % 5 and i in left]) > 110 and len([i for i in range(0, 150, 5) if i in left]) < 6


def test_near_duplicate_stage_keeps_one_of_each_class(spark, corpus):
    docs, path = corpus
    rows = triples(docs)
    by_id = {i: (i, t) for i, t, *_ in rows if i is not None}
    classes = brute_join(by_id.values())
    got = collections.Counter(r.doc_id for r in C.near_duplicates(spark, docs, path).collect())
    expected = {i for i in by_id if classes[i][0] == i}
    assert {i for i in got if i is not None} == expected and got[None] == 2
    assert all(n == 1 for i, n in got.items() if i is not None)


def test_near_duplicate_stage_keeps_unrelated_texts_of_one_id(spark, corpus, docs_of, prose):
    _, path = corpus
    a, b, c = (prose(f"shared id {k}", 80) for k in "abc")
    near = a.split()
    near[40] = "changed"
    rows = [(5, a, "en", "s"), (5, b, "en", "s"), (5, b, "en", "s"), (3, " ".join(near), "en", "s"), (9, c, "en", "s"), (5, "", "en", "s"), (None, a, "en", "s")]
    got = C.near_duplicates(spark, docs_of(rows).repartition(3), path).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(5, b), (3, " ".join(near)), (9, c), (5, ""), (0, a)])


def test_repeat_stage_cuts_texts(spark, corpus):
    docs, path = corpus
    rows = triples(docs)
    expected = brute_repeats([(k, t) for k, (_, t, *_) in enumerate(rows)])
    removed = {k: n for k, _, n, *_ in expected}
    out = C.suffix_array_dedup(spark, docs, path).collect()
    gone = sum(1 for k, (_, t, *_) in enumerate(rows) if removed[k] and removed[k] == len((t or "").encode()))
    assert len(out) <= len(rows) and len(out) >= len(rows) - gone
    size = lambda t: len((t or "").encode())
    assert sum(size(r.text) for r in out) == sum(size(t) for _, t, *_ in rows) - sum(removed.values())
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out)
    assert {r.doc_id for r in out} >= {200, 201, 202}


def test_mixing_stage_repeats_rows(spark, corpus):
    docs, path = corpus
    before, after = collections.Counter(plain(docs)), collections.Counter(plain(C.mix_sources(spark, docs, path)))
    assert set(after) <= set(before) and all(n <= 2 * before[r] for r, n in after.items())
    assert after == collections.Counter(plain(C.mix_sources(spark, docs.repartition(5), path)))
    words = lambda t: len((t or "").split())
    total = sum(words(r[1]) * n for r, n in before.items())
    assert abs(sum(words(r[1]) * n for r, n in after.items()) - 1.5 * total) <= 5 * max(words(r[1]) for r in before)
    assert all(after[r] == n for r, n in before.items() if not words(r[1]))


def test_run_applies_every_stage(spark, corpus):
    docs, path = corpus
    for _, stage in C.STAGES:
        docs = C.materialize(stage(spark, docs, path), "test-stage")
    got = plain(C.run(spark, path))
    assert got == plain(docs) and len(got) > 50
    assert set(C.run(spark, path).columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert byte_bpe.CACHE_ENTRIES > 0
