"""Byte-level BPE against tiktoken, and decoding as an exact round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from salesight.llm import byte_bpe as B

NAMES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
SCHEMA = "doc_id bigint, text string, ids string, `a.b` int, n_tokens string"


@pytest.fixture(scope="module", params=NAMES)
def both(request):
    ranks = B.read_ranks(public_tokenizers.path(request.param))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return B.Codec(B.vocabulary(ranks, public_tokenizers.PATTERN)), plain


def odd_texts():
    rng = random.Random(4)
    texts = ["", " ", "\n \n\t  x", "don't WE'LL it's 'S", "<|endoftext|> x", "naïve café 日本語 ١٢٣ ² \U0001f600‍", "\x00\x1c\x85\xa0　 y"]
    texts += ["a" * 5000, "ab" * 4000, " " * 3000 + "x", "\n" * 2000, "日" * 1500]
    texts += ["".join(rng.choice("abcdefgh") for _ in range(20_000)), "".join(rng.choice(" aé1'\n#") for _ in range(5000))]
    return texts


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 5, 1000, 30_000):
        hashes = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n + n // 10 + 5).astype(np.uint64))[:n]
        made = B.perfect_hash(hashes)
        assert sorted(made.find(hashes).tolist()) == list(range(n))
        assert (made.find(hashes + np.uint64(1 << 63)) == -1).all()


def test_equals_tiktoken(both):
    codec, plain = both
    for text in odd_texts():
        ids = codec.encode_text(text)
        assert ids == plain.encode_ordinary(text)
        assert codec.decode_bytes(ids) == text.encode()


def test_every_character(both):
    codec, plain = both
    every = [chr(i) for i in range(0x40000) if not 0xD800 <= i < 0xE000]
    text = "".join(f"a{c}b {c}{c} 1{c}" for c in every)
    assert codec.encode_text(text) == plain.encode_ordinary(text)


def test_classes_of_characters():
    """Bytes that only join an ASCII neighbour: the pairs tell the class of every character."""
    for mark in "a1!":
        ranks = {bytes([i]): i for i in range(256)}
        for b in range(0x80, 0xC0):
            ranks[bytes([b]) + mark.encode()] = len(ranks)
        plain = tiktoken.Encoding("pairs", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        codec = B.Codec(B.vocabulary(ranks, public_tokenizers.PATTERN))
        text = "\n".join(chr(i) + mark for i in range(0x80, 0x40000) if not 0xD800 <= i < 0xE000)
        assert codec.encode_text(text) == plain.encode_ordinary(text)


def test_whole_entries_and_merges(both):
    codec, plain = both
    vocab = codec.vocab
    raw, at = vocab.data.tobytes(), vocab.starts
    rng = random.Random(1)
    for i in rng.sample(sorted(codec.ranks.values()), 400):
        piece = raw[at[i] : at[i + 1]]
        assert codec.vocab.hash.find(B.T.byte_hasher(np.frombuffer(piece, np.uint8))(np.array([0]), np.array([len(piece)])))[0] >= 0
    for _ in range(300):
        piece = bytes(rng.randrange(256) for _ in range(rng.randrange(1, 40)))
        assert B.merge(piece, codec.ranks, codec.pairs) == plain._encode_single_piece(piece) or piece in codec.ranks


def test_cache_generations(both, monkeypatch):
    monkeypatch.setattr(B, "CACHE_ENTRIES", 7)
    codec, plain = both
    rng = random.Random(2)
    words = ["".join(rng.choice("qzxjkv") for _ in range(6)) for _ in range(40)]
    text = " ".join(rng.choice(words) for _ in range(2000))
    codec.young, codec.old = {}, {}
    assert codec.encode_text(text) == plain.encode_ordinary(text)
    assert len(codec.young) <= 7 and len(codec.old) <= 7


def check(rows, spark, name):
    ranks = B.read_ranks(public_tokenizers.path(name))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(3)
    path = public_tokenizers.path(name)
    found = B.round_trip(docs, path, public_tokenizers.PATTERN).collect()
    expected = []
    for i, text in rows:
        ids = plain.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((i, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    return docs, path, plain


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, name, monkeypatch):
    rows = list(enumerate(odd_texts())) + [(None, None), (None, "x y"), (3, "x y"), (3, "x y"), (99, None)]
    docs, path, plain = check(rows, spark, name)
    held = B.encoded(docs, path, public_tokenizers.PATTERN)
    assert sorted(str((r.doc_id, r.ids)) for r in held.collect()) == sorted(
        str((i, plain.encode_ordinary(t or ""))) for i, t in rows
    )
    back = B.decoded(held, path, public_tokenizers.PATTERN).collect()
    assert sorted(str((r.doc_id, bytes(r.text))) for r in back) == sorted(str((i, (t or "").encode())) for i, t in rows)
    assert B.round_trip(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_blocks_inside_and_across_rows(both, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_TOKENS", 50)
    monkeypatch.setattr(B, "BLOCK_CHARS", 300)
    codec, plain = both
    texts = odd_texts()
    got = [[] for _ in texts]
    for held in B.blocks(codec, iter(texts)):
        assert sum(len(p) for _, p in held) < 50 + 300
        ids, at = codec.encode([p for _, pieces in held for p in pieces])
        first = 0
        for row, pieces in held:
            got[row] += ids[at[first] : at[first + len(pieces)]].tolist()
            first += len(pieces)
    assert got == [plain.encode_ordinary(t) for t in texts]


def test_whole_table(spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, spark, NAMES[0])
