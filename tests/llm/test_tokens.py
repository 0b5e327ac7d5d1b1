import base64
import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, token_counts
from tidemark.llm.queries import encoded_digests

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = "abcABC  \t\n\r\x1c\x85\xa0 　ÉéßΣσςİıſK0123①½²Ⅳ中文ノア한글اع'´`\"’!?.,;:_-+<|>endoftext🎉👩é̀ö﻿​힣\U0001d400"


def texts(n=3000):
    rng = random.Random(7)
    made = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(n)]
    fixed = ["", " ", "  ", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "a" * 3000, "ab" * 2000, "é" * 2000]
    return [*made, *fixed, " " * 500, "\n\n\n  a  \n", " a ", "a\n b", "I'll don't 'RE 'S x's", "%" * 50]


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTES, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_equal_the_library():
    library = Tokenizer.from_file(WORDS)
    wanted = [len(e.ids) for e in library.encode_batch(texts(), add_special_tokens=False)]
    counter = token_counts.ChunkCounter(token_counts.load_word_bpe(WORDS), most=500)
    got = []
    for i in range(0, len(wanted), 100):
        got += counter.counts([t.encode() for t in texts()[i : i + 100]])
    assert got == wanted


def test_single_merges_give_the_same_counts():
    bpe = token_counts.load_word_bpe(WORDS)
    words = [w for t in texts(300) for w in t.encode().lower().split()][:400]
    assert [token_counts._one_by_one(w, bpe) for w in words] == token_counts.surviving_symbols(words, bpe).tolist()


def test_count_tokens_of_odd_rows(frame, odd_rows):
    library = Tokenizer.from_file(WORDS)
    got = token_counts.count_tokens(frame(odd_rows), WORDS, limit=20).collect()
    wanted = []
    for i, text, *_ in odd_rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        wanted.append((i, len((text or "").encode()), n, n > 20))
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_encoding_equals_the_library(encoding):
    encoder = byte_bpe.Encoder(byte_bpe.load_byte_bpe(BYTES, public_tokenizers.PATTERN), most=500)
    given = texts()
    for i in range(0, len(given), 100):
        got = [np.frombuffer(x, np.int32).tolist() for x in encoder.encode(given[i : i + 100])]
        assert got == [encoding.encode_ordinary(t) for t in given[i : i + 100]]


def test_single_merges_give_the_same_ids(encoding):
    bpe = byte_bpe.load_byte_bpe(BYTES, public_tokenizers.PATTERN)
    for word in ["hello", " naïveté", "aaaaaaa", "中文"]:
        assert byte_bpe.one_by_one(word.encode(), bpe) == encoding.encode_ordinary(word)


def most_held(function, *args):
    """Bytes that the call holds at most, and what it returns."""
    tracemalloc.start()
    try:
        out = function(*args)
        return tracemalloc.get_traced_memory()[1], out
    finally:
        tracemalloc.stop()


def test_a_replay_holds_little_for_each_byte(encoding):
    bpe = byte_bpe.load_byte_bpe(BYTES, public_tokenizers.PATTERN)
    rng = random.Random(3)
    words = list({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 12))) for _ in range(80_000)})
    given = [w.encode() for w in words]
    held, ids = most_held(lambda: byte_bpe.Replay(given, bpe).run())
    assert held < 50 * sum(map(len, given))
    assert [np.frombuffer(i, np.int32).tolist() for i in ids[:500]] == [encoding.encode_ordinary(w) for w in words[:500]]


def test_first_pairs_are_entered_by_blocks(encoding, monkeypatch):
    monkeypatch.setattr(byte_bpe, "ENTERED", 7)
    encoder = byte_bpe.Encoder(byte_bpe.load_byte_bpe(BYTES, public_tokenizers.PATTERN))
    got = [np.frombuffer(x, np.int32).tolist() for x in encoder.encode(texts(200))]
    assert got == [encoding.encode_ordinary(t) for t in texts(200)]


def test_decoding_holds_little_for_each_byte(monkeypatch):
    flat, starts = byte_bpe._token_bytes(byte_bpe.load_byte_bpe(BYTES, public_tokenizers.PATTERN))
    ids = np.random.default_rng(5).integers(0, len(starts) - 1, 1_000_000)
    ids = ids[np.diff(starts)[ids] > 0].astype(np.int32)
    ends = np.array([0, 0, 7, len(ids) // 2, len(ids) // 2, len(ids)])
    held, (content, row_ends) = most_held(byte_bpe.decode_arrays, ids, ends, flat, starts)
    assert held < 10 * len(content)
    tokens = [flat[starts[i] : starts[i + 1]] for i in ids.tolist()]
    assert content.tobytes() == b"".join(t.tobytes() for t in tokens)
    assert row_ends.tolist() == np.r_[0, np.cumsum([len(t) for t in tokens])][ends].tolist()
    monkeypatch.setattr(byte_bpe, "DECODED", 3)
    few, few_ends = byte_bpe.decode_arrays(ids[:10], np.array([0, 4, 10]), flat, starts)
    assert few.tobytes() == b"".join(t.tobytes() for t in tokens[:10]) and few_ends[-1] == len(few)


def test_of_a_full_memory_what_is_met_again_is_not_replayed(monkeypatch):
    replayed = []

    class Counted(byte_bpe.Replay):
        def __init__(self, words, bpe):
            replayed.append(set(words))
            super().__init__(words, bpe)

    monkeypatch.setattr(byte_bpe, "Replay", Counted)
    encoder = byte_bpe.Encoder(byte_bpe.load_byte_bpe(BYTES, public_tokenizers.PATTERN), most=4)
    first = encoder.encode(["one two three"])[0]
    assert encoder.encode(["one two three four five six"])[0].startswith(first)
    assert replayed == [{b"one", b" two", b" three"}, {b" four", b" five", b" six"}]


def test_encode_and_decode_odd_rows(spark, frame, odd_rows, encoding):
    got = encoded_digests(frame(odd_rows)).collect()
    wanted = []
    for i, text, *_ in odd_rows:
        ids = encoding.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        wanted.append((i, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
    nulls = spark.createDataFrame([(1, None), (2, [0])], "decoded int, ids array<int>")
    assert [r["decoded"] for r in byte_bpe.decode(nulls, BYTES, public_tokenizers.PATTERN).collect()] == [None, b"!"]


def test_empty_tables(frame):
    assert token_counts.count_tokens(frame([]), WORDS).count() == 0
    assert encoded_digests(frame([])).count() == 0
