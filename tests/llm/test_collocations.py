import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest

from tidemark.llm import collocations as c
from tidemark.llm.misra_gries import Summary, capacity_for

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(rows, least, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            f[lang].update(" ".join(words[i : i + m]) for m in range(1, 6) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        good = {p: a for p, a in counts.items() if a >= least and " " in p}
        rows, longest = [], Counter()
        for q, b in good.items():
            words = q.split(" ")
            for inner in {" ".join(words[i : i + m]) for m in range(2, len(words)) for i in range(len(words) - m + 1)}:
                longest[inner] = max(longest[inner], b)
        for p, a in good.items():
            if longest[p] >= a:
                continue
            words = p.split(" ")
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[" ".join(words[:k])], counts[" ".join(words[k:])]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            rows.append((lang, p, a, left, right, n[lang], score))
        rows.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(rows[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r[k] for k in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize("least", [2, 7])
def test_equals_brute_force(frame, least):
    rng = random.Random(least)
    words = ["Über", "the", "of", "New", "york", "x-1", "état", "THE"]
    rows = [
        (i, " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ",\t", "\n", " \t "]) for _ in range(rng.randrange(60))),
         rng.choice(["en", "en", "de", None, "und"]), None)
        for i in range(80)
    ]
    assert got(c.collocations(frame(rows), least=least)) == brute(rows, least)
    assert got(c.collocations(frame(rows), least=least, top=3)) == brute(rows, least, 3)


def test_odd_rows(frame, odd_rows):
    assert got(c.collocations(frame(odd_rows), least=3)) == brute(odd_rows, 3)


def test_without_rows_or_phrases(frame):
    assert c.collocations(frame([(1, "a b", "en", None)]).filter("false")).collect() == []
    assert c.collocations(frame([(1, "a b", "en", None), (2, None, None, None)])).collect() == []


def test_hot_phrase_over_many_partitions(spark, frame):
    rows = [(i, "very common pair here", "en", None) for i in range(500)] + [(i, "another line", "fr", None) for i in range(99)]
    assert got(c.collocations(frame(rows).repartition(31))) == brute(rows, 100)


def grams(parts, n):
    out = Counter()
    for part in parts:
        words = c.cut_words([part])
        hashes = c.gram_hashes(words, np.zeros(1, np.uint64), words.inside(n), n)
        out.update(hashes.tolist())
    return out


@pytest.mark.parametrize("size", [1, 3, 10, 64])
def test_blocks_of_a_long_text_have_its_grams(size):
    rng = random.Random(size)
    for _ in range(30):
        text = "".join(rng.choice(["ab", "c", " ", "  ", "\t", ". ", "\n", "Déf "]) for _ in range(rng.randrange(80))).encode()
        parts = list(c.blocks(text, size))
        assert b"".join(p[:own] for p, own in parts) == text
        for n in range(1, 6):
            assert grams(parts, n) == grams([(text, len(text))], n)


def test_summaries_lose_no_frequent_key():
    rng = np.random.default_rng(3)
    for _ in range(20):
        keys = np.concatenate([rng.zipf(1.3, 3000) % 500, np.arange(1000, 4000)]).astype(np.int64)
        rng.shuffle(keys)
        threshold = int(rng.integers(5, 60))
        summary = Summary(capacity_for(len(keys), threshold, 1), gathered=50)
        for part in np.array_split(keys, 40):
            summary.add(*np.unique(part, return_counts=True))
        found = set(summary.at_least(threshold).tolist())
        values, counts = np.unique(keys, return_counts=True)
        assert set(values[counts >= threshold].tolist()) <= found
        assert len(summary.keys) <= summary.capacity and summary.lost * summary.capacity < len(keys)


def test_entries_of_a_row_come_back():
    rng = np.random.default_rng(4)
    for size in (0, 1, 2, 256):
        keys = np.unique(rng.integers(0, 1 << 8 * c.HASH_BYTES, size))
        keys[-1:] = (1 << 8 * c.HASH_BYTES) - 1
        assert (np.cumsum(c.from_planes(c.planes(np.diff(keys, prepend=0), c.HASH_BYTES), c.HASH_BYTES)) == keys).all()
        counts = rng.integers(1, 1 << 62, size)
        assert (c.from_planes(c.planes(counts, 8), 8) == counts).all()


def test_short_hashes_keep_their_partition():
    hashes = np.random.default_rng(8).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for partitions in (1, 7, 200):
        short = c.shortened(hashes, partitions)
        assert (short % np.uint64(partitions) == hashes % np.uint64(partitions)).all()
        assert (short // np.uint64(partitions) < 1 << 8 * c.HASH_BYTES).all() and len(np.unique(short)) == 1000


def test_equal_hashes_are_told_apart():
    table = np.array([[1, 2, 0], [1, 3, 0], [1, 2, 0]])
    rows, counts = c._distinct(np.zeros(3, np.uint64), table)
    assert sorted(zip(map(tuple, rows), counts)) == [((1, 2, 0), 2), ((1, 3, 0), 1)]


def test_bitmap_has_all_its_keys(spark):
    keys = np.random.default_rng(5).integers(-(1 << 63), 1 << 63, 5000)
    bitmap = c.bitmap_of(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    assert bitmap.has(keys.view(np.uint64)).all()
    others = np.random.default_rng(6).integers(-(1 << 63), 1 << 63, 5000)
    assert bitmap.has(others.view(np.uint64)).mean() < 0.001


def test_products_beyond_64_bits_are_exact(spark):
    big = 10**12 + 39
    counts = spark.createDataFrame([("en", "a", big), ("en", "b", big + 7), ("en", "a b", big - 11)], "lang string, phrase string, a long")
    totals = spark.createDataFrame([("en", 10**13 + 1)], "lang string, n long")
    row = c.scored(counts, totals).first()
    assert row["score"] == 1000 * (big - 11) * (10**13 + 1) // (big * (big + 7)) and Decimal(row["l"]) == big
