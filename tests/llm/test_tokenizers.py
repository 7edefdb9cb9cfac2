"""Operators on tokens against the public libraries, and exact round trips."""

import base64
import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from mercato.llm import byte_bpe, token_counts, token_files  # noqa: E402
from mercato.llm.common import python_tasks  # noqa: E402

ALPHABET = "ab c'sdlrevmté\n\t \xa0 　 0123!?.,;日本語🙂\x1c\x1f\x85İΣß<|"
ODD = ["", " ", "  ", "\n \n", "a \nb", "a\n  b", "'re're'rx''s 'l'll'v", "x<|endoftext|>y <|startoftext|><|ENDOFTEXT|>",
       "a" * 9000, "é" * 5000 + " b" + "c" * 5000, "!" * 300, "'" * 50, "'ll" * 3000, "́a ́", "ab" * 20000, " " * 3000 + "x"]


def texts(n, seed):
    rng = random.Random(seed)
    return ODD + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows(docs_of):
    some = [*texts(300, 5), None]
    return [*((i, t, "en", "s") for i, t in enumerate(some)), (3, "again", "en", "s"), (3, "again", "en", "s"), (None, "no id", "en", "s")]


def test_byte_bpe_as_tiktoken():
    tiktoken = pytest.importorskip("tiktoken")
    path = P.path("byte_bpe_multi_50k.tiktoken")
    codec = byte_bpe.Codec(path, P.PATTERN)
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for t in texts(3000, 1):
        ids = codec.encode(t)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == enc.encode_ordinary(t), repr(t[:80])
        assert codec.decode(ids) == t.encode()


def test_merge_pops_lowest_rank_then_leftmost():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 300, b"aaa": 290, b"ba": 301, b"aab": 1000}
    assert byte_bpe.merge(b"aaaaa", ranks) == [290, 300]
    assert byte_bpe.merge(b"aab", ranks) == [1000]
    assert byte_bpe.merge(b"baa", ranks) == [98, 300]


def test_round_trip_query(spark, docs_of, rows):
    python_tasks(spark)
    path = P.path("byte_bpe_multi_50k.tiktoken")
    docs = docs_of(rows).withColumnRenamed("id", "other").withColumnRenamed("doc_id", "id")
    got = byte_bpe.round_trip(docs, path, P.PATTERN).collect()
    codec = byte_bpe.codec(path, P.PATTERN)
    expected = []
    for i, t, _, _ in rows:
        ids = codec.encode(t or "")
        expected.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    encoded = byte_bpe.encode(docs, path, P.PATTERN)
    decoded = byte_bpe.decode(encoded, path, P.PATTERN).collect()
    assert sorted((str(r.id), bytes(r.bytes)) for r in decoded) == sorted((str(i), (t or "").encode()) for i, t, _, _ in rows)
    assert byte_bpe.round_trip(docs.limit(0), path, P.PATTERN).count() == 0


def test_token_counts_as_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = P.path("word_bpe_49k.json")
    machine, library = token_counts.Machine(path), tokenizers.Tokenizer.from_file(path)
    for t in texts(3000, 2):
        assert machine.count(t) == len(library.encode(t, add_special_tokens=False).ids), repr(t[:80])


def test_token_counts_as_library_for_characters_of_any_unicode_version():
    tokenizers = pytest.importorskip("tokenizers")
    import unicodedata
    path = P.path("word_bpe_49k.json")
    machine, library = token_counts.Machine(path), tokenizers.Tokenizer.from_file(path)
    new = [c for c in map(chr, range(0xE0000)) if not "\ud800" <= c <= "\udfff" and unicodedata.category(c) == "Cn" and len(library.pre_tokenizer.pre_tokenize_str("a" + c)) == 1]
    assert len(new) > 1000      # letters that the library knows and Python does not
    some = [m + c + "x" for m in "\u20b9!'\u0301\u200d5" for c in [*new, "\U0001e5e9", "\U0001e5db", "\U0001e5e6", "\U0001e5f5"]]
    rng = random.Random(6)
    pool = [c for c in map(chr, (rng.randrange(0x110000) for _ in range(20_000))) if not "\ud800" <= c <= "\udfff"] + new
    some += ["".join(rng.choice(pool) if rng.random() < 0.6 else rng.choice("ab 's1!é") for _ in range(rng.randint(1, 15))) for _ in range(10_000)]
    expected = [len(e.ids) for e in library.encode_batch_fast(some, add_special_tokens=False)]
    assert [machine.count(t) for t in some] == expected


def test_token_counts_with_few_states_and_small_chunks(monkeypatch):
    path = P.path("word_bpe_49k.json")
    some = texts(300, 3)
    machine = token_counts.Machine(path)
    expected = [machine.count(t) for t in some]
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    monkeypatch.setattr(token_counts, "CHUNK_CHARS", 7)
    machine = token_counts.Machine(path)
    assert [machine.count(t) for t in some] == expected


def test_chunk_maps_compose_associatively():
    machine = token_counts.Machine(P.path("word_bpe_49k.json"))
    parts = ["the qui", "ck", "", " bro", "wn's f'", "ll ", "ox"]
    maps = [machine.chunk_map(p) for p in parts]
    left = maps[0]
    for m in maps[1:]:
        left = machine.compose(left, m)
    right = maps[-1]
    for m in maps[-2::-1]:
        right = machine.compose(m, right)
    ends = [(lambda s, n: n + s.end())(*machine.apply(m, machine.start)) for m in (left, right)]
    assert ends == [machine.count("".join(parts))] * 2


def test_token_counts_query(spark, docs_of, rows):
    python_tasks(spark)
    path = P.path("word_bpe_49k.json")
    docs = docs_of(rows).withColumnRenamed("id", "other").withColumnRenamed("doc_id", "id")
    got = token_counts.token_counts(docs, path, limit=100).collect()
    machine = token_counts.machine(path)
    expected = [(i, len((t or "").encode()), n := machine.count(t or ""), n > 100) for i, t, _, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert token_counts.token_counts(docs.limit(0), path).count() == 0


def test_pack_and_unpack():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 1023, 1024, 1025, 5000):
        for high in (1, 2, 300, 50_000, 2**32 - 1):
            x = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            x[::17] = rng.integers(0, 2**32 - 1)
            payload = token_files.pack(x)
            assert (token_files.unpack(payload) == x).all()
            if n > 1100:
                assert (token_files.unpack(payload, 1000, 77) == x[1000:1077]).all()


def test_pack_keeps_outliers_apart():
    x = np.full(1024, 5, np.uint32)
    x[100] = 2**31
    assert len(token_files.pack(x)) < 60


def test_token_files_query(spark, docs_of, rows, monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    python_tasks(spark)
    path = P.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    docs = docs_of(rows).withColumnRenamed("id", "other").withColumnRenamed("doc_id", "id")
    got = sorted(map(tuple, token_files.write_and_read(docs.repartition(3), path).collect()), key=lambda r: r[1])
    sized = [(i, np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4")) for i, t, _, _ in rows]
    ids = [i for i, *_ in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert [s for _, s, _, _ in got] == [0, *np.cumsum([n for _, _, n, _ in got])[:-1].tolist()]
    assert sorted(((i, n, c) for i, _, n, c in got), key=str) == sorted(((i, len(x), zlib.crc32(x.tobytes())) for i, x in sized), key=str)
    assert token_files.write_and_read(docs.limit(0), path).count() == 0


def test_token_files_encoder_as_library_on_every_character():
    tokenizers = pytest.importorskip("tokenizers")
    path = P.path("word_bpe_49k.json")
    library, encoder = tokenizers.Tokenizer.from_file(path), token_files.Encoder(path)
    every = [f"a{c}b 1{c} X{c}. {c}, Y{c}" for c in map(chr, range(0x30000)) if not "\ud800" <= c <= "\udfff"]
    for at in range(0, len(every), 10_000):
        part = every[at : at + 10_000]
        expected = [e.ids for e in library.encode_batch_fast(part, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(part)] == expected
