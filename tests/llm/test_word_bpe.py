"""Speculative word BPE against the public library."""

import hashlib
import random
import struct

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from mercato.llm import word_bpe  # noqa: E402
from mercato.llm.common import python_tasks  # noqa: E402
from mercato.llm.runs import Held, worker_tables  # noqa: E402
from tests.llm.test_tokenizers import texts  # noqa: E402

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return word_bpe.Codec(PATH)


def ids_of(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def test_encode_and_decode_as_library(codec, library):
    some = texts(3000, 21)
    for t, ids in zip(some, codec.encode(some), strict=True):
        expected = library.encode(t, add_special_tokens=False).ids
        assert ids_of(ids) == expected, repr(t[:80])
        assert codec.decode(ids).decode() == library.decode(expected, skip_special_tokens=False)


def test_random_unicode_and_all_latin_pairs_as_library(codec, library):
    rng = random.Random(4)
    pool = [c for c in map(chr, (rng.randrange(0x110000) for _ in range(20_000))) if not "\ud800" <= c <= "\udfff"]
    some = ["".join(rng.choice(pool) if rng.random() < 0.5 else rng.choice("abcdeéİ'st .₹\U0001e5e9\U0001e5db́") for _ in range(rng.randint(1, 20)))
            for _ in range(10_000)]
    some += [a + b + "x" for a in map(chr, range(1, 256)) for b in map(chr, range(1, 256))]
    expected = [e.ids for e in library.encode_batch_fast(some, add_special_tokens=False)]
    assert [ids_of(x) for x in codec.encode(some)] == expected


def test_compatible_pairs_are_those_that_merging_leaves_apart(codec):
    m, rng = codec.merges, np.random.default_rng(3)
    names = {i: t for t, i in m.ids.items()}
    inner = np.array([i for t, i in m.ids.items() if not t.endswith(m.end)])
    x, y = rng.choice(inner, 4000), rng.integers(0, m.size, 4000)
    met = m.compatible(x, y)
    assert 200 < met.sum() < 3800
    for a, b, ok in zip(x.tolist(), y.tolist(), met.tolist(), strict=True):
        piece = names[a] + names[b]
        if names[b].endswith(m.end):
            assert (m.exact(piece.removesuffix(m.end)) == [a, b]) == ok, piece


def test_only_failing_pieces_are_merged_exactly(codec, monkeypatch):
    merged = []
    exact = word_bpe.Merges.exact
    monkeypatch.setattr(word_bpe.Merges, "exact", lambda self, piece: merged.append(piece) or exact(self, piece))
    words = ["the", "quick", "tokenization", "qzxv", "aaaaaaa", "hello", "thththth", "ererer", "lowerest"]
    out = codec.merges.encode(words)
    assert [exact(codec.merges, w) for w in words] == out
    assert len(merged) < len(words)
    for w in set(words) - set(merged):
        assert codec.merges.propose(w) == exact(codec.merges, w)


def test_merges_out_of_order_are_refused():
    vocab = {"a": 0, "a</w>": 1, "aa": 2, "aaa": 3}
    with pytest.raises(ValueError, match="made later"):
        word_bpe.Merges(vocab, [("aa", "a"), ("a", "a")], "</w>")


def test_tables_are_bounded_in_bytes_and_let_go():
    held = Held(20_000)
    held.add({f"run{i}": b"x" * 100 for i in range(1000)})
    assert len(held.new) + len(held.old) < 80
    known, missing = held.find({"run999", "run0"})
    assert known == {"run999": b"x" * 100} and missing == ["run0"]
    small = word_bpe.Codec(PATH, run_bytes=2000, piece_bytes=2000)
    some = texts(200, 8)
    assert small.encode(some) == word_bpe.Codec(PATH).encode(some)
    first = worker_tables(("a",), dict)
    assert worker_tables(("a",), dict) is first
    worker_tables(("b",), dict)
    assert worker_tables(("a",), dict) is not first


def test_round_trip_query(spark, docs_of, library):
    python_tasks(spark)
    some = [*texts(300, 5), None]
    rows = [*((i, t, "en", "s") for i, t in enumerate(some)), (3, "again", "en", "s"), (3, "again", "en", "s"), (None, "no id", "en", "s")]
    docs = docs_of(rows, extra=("ids", "n_tokens", "doc")).withColumnRenamed("doc_id", "id")
    got = word_bpe.round_trip(docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    expected = []
    for i, t, _, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                         hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    decoded = word_bpe.decode(word_bpe.encode(docs, PATH), PATH).collect()
    assert sorted((str(r.id), hashlib.sha256(r.text.encode()).hexdigest()) for r in decoded) == sorted((str(i), d) for i, _, _, d in expected)
    assert word_bpe.round_trip(docs.limit(0), PATH).count() == 0
