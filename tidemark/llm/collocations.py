"""Phrase collocations: Misra-Gries summaries find the frequent n-grams, a second pass counts them exactly.

Texts are cut into pieces and words by arrays over their bytes. The n-grams of each length, as hashes, go into
summaries, one for each hash partition: every task sums what it read, summaries of a partition meet in one task and
are merged there with a capacity that exceeds the partition's mass divided by the threshold, so that no frequent n-gram can
be lost and memory is bounded by that capacity, not by the number of different n-grams. Longer n-grams enter only
where all their shorter parts may be frequent: first words, then pairs of such words, then chains of such pairs. What
survives is a bitmap of bounded size. The exact pass counts the n-grams that pass it, as text, so that equal hashes and
false hits of the bitmap cost time and change nothing. Scores, ranks and what longer phrases hold are Spark joins.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.batches import bounded_batches, slices
from tidemark.llm.misra_gries import Summary, capacity_for, summed
from tidemark.llm.text import Shelf, filled

MOST_WORDS = 5
LEAST = 100
TOP = 2000
NO_LANGUAGE = "und"

#: Bytes of text that are cut into words at a time. A longer text is read in blocks.
BLOCK_BYTES = 2 << 20
#: Different n-grams that a task holds before it hands them on, and entries of a row it hands on.
HELD, ROW_ENTRIES = 1 << 20, 256
#: Bytes of a hash that tell n-grams of one hash partition apart.
HASH_BYTES = 5
#: Bits of the bitmap for each key, and bits at most (16 MiB).
KEY_BITS, MOST_BITS = 64, 1 << 27
#: Bits that are set for each key: with 64 times as many bits as keys one in 80,000 others passes.
PROBES = 4
BUCKET_BITS = 32768
#: Score buckets of a language, of which each yields its first rows, before its first rows of all are taken.
BUCKETS = 64

_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_BORDER = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_NEXT_WORDS = re.compile(rb"(?:[ \t.,;:!?\n\x0b\x0c\r]*[^ \t.,;:!?\n\x0b\x0c\r]+){0,%d}" % (MOST_WORDS - 1))


def blocks(text: bytes, size: int = BLOCK_BYTES) -> Iterator[tuple[bytes, int]]:
    """Blocks of a text, each with the words behind its end that n-grams may reach to, and its own length without them."""
    at = 0
    while len(text) - at > size:
        border = _BORDER.search(text, at + size)
        if border is None:
            break
        end = _NEXT_WORDS.match(text, border.start()).end()
        yield text[at:end], border.start() - at
        at = border.start()
    yield text[at:], len(text) - at


@dataclass(frozen=True)
class Words:
    """The words of some blocks in order: their bytes, hash, piece, block, and whether their block owns them."""

    flat: np.ndarray
    ends: np.ndarray
    hash: np.ndarray
    piece: np.ndarray
    block: np.ndarray
    own: np.ndarray

    def inside(self, n: int) -> np.ndarray:
        """Positions at which an n-gram of one piece begins."""
        last = max(0, len(self.hash) - n + 1)
        return np.flatnonzero(self.own[:last] & (self.piece[:last] == self.piece[n - 1 :][:last]))

    def coded(self, used: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """The different words among the used ones, and for each of those the number of its word."""
        ends = pa.py_buffer(np.r_[0, self.ends].astype(np.int32))
        words = pa.Array.from_buffers(pa.binary(), len(self.ends), [None, ends, pa.py_buffer(self.flat)])
        found = words.filter(pa.array(used)).dictionary_encode()
        code = np.zeros(len(self.hash), np.int64)
        code[used] = found.indices.to_numpy(zero_copy_only=False)
        return found.dictionary.to_pylist(), code


#: One number for each byte value, and the factor and its inverse that give it its place in a word.
_BYTE = np.random.default_rng(1).integers(0, 1 << 63, 256, np.uint64)
_FACTOR = 0x9E3779B97F4A7C15
_BACK = pow(_FACTOR, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1, n being a power of two."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out


def _word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word: the sum of its bytes' numbers times powers of a factor, from differences of one running sum."""
    if not len(ends):
        return np.zeros(0, np.uint64)
    size = 1 << len(flat).bit_length()
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[flat] * _powers(_FACTOR, size)[: len(flat)])])
    return _mixed((run[ends] - run[starts]) * _powers(_BACK, size)[starts])


def cut_words(parts: list[tuple[bytes, int]]) -> Words:
    buffer = np.frombuffer(b"\n".join([b"", *(p for p, _ in parts), b""]).lower(), np.uint8)
    kind = _KIND[buffer]
    inside = kind == 0
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = turns[::2], np.cumsum(turns[1::2] - turns[::2])
    flat = buffer[inside]
    sizes = np.array([len(p) + 1 for p, _ in parts])
    begins = np.cumsum(sizes) - sizes + 1
    first = np.searchsorted(starts, begins)
    block = np.repeat(np.arange(len(parts)), np.diff(np.r_[first, len(starts)]))
    own = starts - begins[block] < np.array([n for _, n in parts])[block]
    hashes = _word_hashes(flat, np.r_[0, ends][:-1], ends)
    return Words(flat, ends, hashes, np.cumsum(kind == 2, dtype=np.int32)[starts], block, own)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def gram_hashes(words: Words, languages: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram at each position, its language included; `languages` has a hash for each block."""
    out = _mixed(words.hash[at] ^ languages[words.block[at]])
    for i in range(1, n):
        out = _mixed(out * np.uint64(_FACTOR) + words.hash[at + i])
    return out


def shortened(hashes: np.ndarray, partitions: int) -> np.ndarray:
    """Hashes of `HASH_BYTES` bytes in each hash partition: those modulo `partitions` is the partition. Of n keys of a
    partition about n / 2^40 share their hash with another, which can only make them look more frequent."""
    return hashes % np.uint64(partitions << 8 * HASH_BYTES)


def planes(values: np.ndarray, size: int) -> bytes:
    """Numbers of `size` bytes, first the lowest byte of each, then the next ones: high bytes are zeros, and compress."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:size].tobytes()


def from_planes(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(size, -1).T
    return out.view("<i8").ravel()


class Bitmap:
    """Which keys may be among the survivors. Some bits for each, in a number of bits that is a power of two."""

    def __init__(self, bits: int, rows: list[tuple[int, bytes]]):
        self.mask = np.uint64(bits - 1)
        self.bytes = np.zeros(bits // 8, np.uint8)
        for bucket, part in rows:
            self.bytes[bucket * BUCKET_BITS // 8 : (bucket + 1) * BUCKET_BITS // 8] = np.frombuffer(part, np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.zeros(len(keys), bool), np.arange(len(keys))
        for i in range(PROBES):
            slot = ((keys & self.mask) + np.uint64(i) * ((keys >> np.uint64(32)) & self.mask)) & self.mask
            bit = self.bytes[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)
            left, keys = left[bit & 1 == 1], keys[bit & 1 == 1]
        out[left] = True
        return out


def bitmap_of(keys: DataFrame) -> Bitmap:
    """The bitmap of stored keys: built in the tasks, at most 16 MiB on the driver; beyond its size it lets more through."""
    bits = max(BUCKET_BITS, min(MOST_BITS, 1 << math.ceil(math.log2(KEY_BITS * max(1, keys.count())))))
    first, step = F.pmod("key", F.lit(bits)), F.pmod(F.shiftrightunsigned("key", 32), F.lit(bits))
    slots = keys.select(F.explode(F.array(*[F.pmod(first + i * step, F.lit(bits)) for i in range(PROBES)])).alias("slot"))
    placed = slots.select(F.floor(F.col("slot") / BUCKET_BITS).alias("bucket"), F.pmod("slot", F.lit(BUCKET_BITS)).alias("at"))
    rows = placed.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).collect()
    return Bitmap(bits, [(r["bucket"], bytes(r["bits"])) for r in rows])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[bytes]]]:
    """The words of texts, some blocks at a time, and the language of each block."""
    for part in slices(batches, "text", BLOCK_BYTES):
        texts, languages = part.column("text"), part.column("lang").to_pylist()
        if part.num_rows > 1:
            yield cut_words([(t, len(t)) for t in texts.to_pylist()]), [t.encode() for t in languages]
        else:
            for block in blocks(texts[0].as_py()):
                yield cut_words([block]), [languages[0].encode()]


def _language_hashes(languages: list[bytes]) -> np.ndarray:
    known = {lang: xxhash.xxh64_intdigest(lang, 1) for lang in set(languages)}
    return np.array([known[lang] for lang in languages], np.uint64)


def added(keys: np.ndarray, counts: np.ndarray, more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys and their counts, with single occurrences of keys added."""
    fresh = np.sort(np.concatenate([keys[:0], *more]))
    first = np.flatnonzero(np.r_[True, fresh[1:] != fresh[:-1]][: len(fresh)])
    fresh, ones = fresh[first], np.diff(np.r_[first, len(fresh)])
    return (fresh, ones) if not len(keys) else summed(np.concatenate([keys, fresh]), np.concatenate([counts, ones]))


def _survivors(texts: DataFrame, shelf: Shelf, lengths: range, least: int, shorter: Bitmap | None) -> DataFrame:
    """Mixed short hashes of all n-grams of these lengths that occur `least` times, and of some others.

    `shorter` holds the words that may be frequent, for pairs, or the pairs, for longer n-grams.
    """
    spark = texts.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = spark.sparkContext.broadcast(shorter)

    def hashed(words: Words, languages: np.ndarray) -> Iterator[np.ndarray]:
        part, ok = (1 if lengths[0] == 2 else 2), None
        if sent.value is not None:
            # Of each position, whether the part that begins there may be frequent; parts behind the block's end count too.
            starts = np.arange(max(0, len(words.hash) - part + 1))
            ok = np.zeros(len(words.hash), bool)
            ok[starts] = sent.value.has(_mixed(shortened(gram_hashes(words, languages, starts, part), partitions)))
        for n in lengths:
            at = words.inside(n)
            if ok is not None:
                for i in range(n - part + 1):
                    at = at[ok[at + i]]
            yield shortened(gram_hashes(words, languages, at, n), partitions).view(np.int64)

    def rows(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Ascending keys and their counts by hash partition, `ROW_ENTRIES` to a row, as differences."""
        part = (keys % partitions).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, keys, counts = part[order], keys[order] // partitions, counts[order]
        bounds = np.searchsorted(part, np.arange(partitions + 1))
        starts = np.concatenate([np.arange(a, b, ROW_ENTRIES) for a, b in zip(bounds[:-1], bounds[1:])])
        if len(starts):
            ends = np.r_[starts[1:], len(keys)]
            steps = [planes(np.diff(keys[a:b], prepend=0), HASH_BYTES) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[starts]), pa.array(np.add.reduceat(counts, starts)), pa.array(steps, pa.binary()),
                 pa.array([planes(counts[a:b], 8) for a, b in zip(starts, ends)], pa.binary())],
                ["part", "mass", "steps", "counts"],
            )

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting, n_waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
        for words, languages in _read(batches):
            for found in hashed(words, _language_hashes(languages)):
                waiting.append(found)
                n_waiting += len(found)
            if n_waiting > HELD:
                keys, counts = added(keys, counts, waiting)
                waiting, n_waiting = [], 0
                if len(keys) > HELD:
                    # Handed on as it is: nothing is taken off a counter before a partition's mass is known.
                    yield from rows(keys, counts)
                    keys, counts = keys[:0], counts[:0]
        yield from rows(*added(keys, counts, waiting))

    parts = texts.mapInArrow(summarise, "part int, mass long, steps binary, counts binary")
    parts = shelf.put(parts, "summaries")
    # One row for each hash partition, as many as `spark.sql.shuffle.partitions` says.
    masses = parts.groupBy("part").agg(F.sum("mass").alias("mass"))
    met = parts.drop("mass").join(F.broadcast(masses), "part").repartition(partitions, "part").sortWithinPartitions("part")

    def survivors(part: int, summary: Summary) -> pa.RecordBatch:
        keys = summary.at_least(least) * partitions + part
        return pa.RecordBatch.from_arrays([pa.array(_mixed(keys.view(np.uint64)).view(np.int64))], ["key"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, summary = None, None
        for batch in batches:
            columns = (batch.column(c) for c in ("part", "mass", "steps", "counts"))
            for part, mass, steps, counts in zip(*(c.to_pylist() for c in columns)):
                if part != now:
                    if summary is not None:
                        yield survivors(now, summary)
                    now, summary = part, Summary(capacity_for(mass, least))
                summary.add(np.cumsum(from_planes(steps, HASH_BYTES)), from_planes(counts, 8))
        if summary is not None:
            yield survivors(now, summary)

    return shelf.put(met.mapInArrow(merge, "key long"), "survivors")


def phrase_counts(texts: DataFrame, shelf: Shelf, survivors: DataFrame) -> DataFrame:
    """(lang, phrase, a) of the n-grams that pass the survivors' bitmap, counted exactly, and of each language, as the
    empty phrase, the number of its words."""
    sent = texts.sparkSession.sparkContext.broadcast(bitmap_of(survivors))

    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def rows(held: dict[tuple[bytes, bytes], int]) -> Iterator[pa.RecordBatch]:
        """The counts by hash partition, `ROW_ENTRIES` to a row."""
        parts: dict[int, list[tuple[bytes, bytes]]] = {}
        for key in held:
            parts.setdefault(xxhash.xxh64_intdigest(key[1], 2) % partitions, []).append(key)
        cut = [(part, keys[i : i + ROW_ENTRIES]) for part, keys in parts.items() for i in range(0, len(keys), ROW_ENTRIES)]
        for at in range(0, len(cut), ROW_ENTRIES):
            some = cut[at : at + ROW_ENTRIES]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part for part, _ in some], pa.int32()),
                 pa.array([[k[0] for k in keys] for _, keys in some], pa.list_(pa.binary())),
                 pa.array([[k[1] for k in keys] for _, keys in some], pa.list_(pa.binary())),
                 pa.array([[held[k] for k in keys] for _, keys in some], pa.list_(pa.int64()))],
                ["part", "lang", "phrase", "a"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bytes, bytes], int] = {}
        for words, languages in _read(batches):
            hashes = _language_hashes(languages)
            numbers = {h: lang for h, lang in zip(hashes.view(np.int64).tolist(), languages)}
            for lang, own in zip(languages, np.bincount(words.block[words.own], minlength=len(languages)).tolist()):
                held[lang, b""] = held.get((lang, b""), 0) + own
            found, used = [], np.zeros(len(words.hash), bool)
            for n in range(1, MOST_WORDS + 1):
                at = words.inside(n)
                keys = gram_hashes(words, hashes, at, n)
                known = sent.value.has(_mixed(shortened(keys, partitions)))
                found.append((n, at[known], keys[known]))
                for i in range(n):
                    used[found[-1][1] + i] = True
            text, code = words.coded(used)
            for n, at, keys in found:
                table = np.stack([*(code[at + i] for i in range(n)), hashes[words.block[at]].view(np.int64)], axis=1)
                for row, many in zip(*_distinct(keys, table)):
                    key = numbers[row[-1]], b" ".join([text[c] for c in row[:-1]])
                    held[key] = held.get(key, 0) + many
            if len(held) > HELD // 4:
                yield from rows(held)
                held = {}
        yield from rows(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of one hash partition after the other: its phrases, all or nearly all of them frequent."""
        now, sums = None, {}
        for batch in batches:
            for part, *lists in zip(*(batch.column(c).to_pylist() for c in ("part", "lang", "phrase", "a"))):
                if part != now:
                    yield summed_rows(sums)
                    now, sums = part, {}
                for lang, phrase, a in zip(*lists):
                    sums[lang, phrase] = sums.get((lang, phrase), 0) + a
        yield summed_rows(sums)

    def summed_rows(sums: dict[tuple[bytes, bytes], int]) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in sums], pa.binary()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(list(sums.values()), pa.int64())], ["lang", "phrase", "a"])

    counted = texts.mapInArrow(count, "part int, lang array<binary>, phrase array<binary>, a array<long>")
    met = counted.repartition(partitions, "part").sortWithinPartitions("part")
    return met.mapInArrow(add, "lang binary, phrase binary, a long")


def _distinct(keys: np.ndarray, table: np.ndarray) -> tuple[list[list[int]], list[int]]:
    """The different rows of a table and how often each stands there, given a hash of each row."""
    if not len(keys):
        return [], []
    _, first, back, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    if not (table == table[first[back]]).all():
        # Two rows of one hash: compare whole rows.
        different, counts = np.unique(table, axis=0, return_counts=True)
        return different.tolist(), counts.tolist()
    return table[first].tolist(), counts.tolist()


def _whole(name: str) -> Column:
    """An integer column for exact products of up to 38 digits."""
    return F.col(name).cast("decimal(18,0)")


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases of two or more words with the score of their lowest-scoring cut: lang, phrase, a, l, r, n, score.

    `counts` has (lang, phrase, a) of all frequent phrases and words, `totals` (lang, n). Both parts of a frequent phrase
    are frequent, so they are there. Products are exact up to 38 digits.
    """
    size = F.size(F.split("phrase", " "))
    cut = counts.withColumn("size", size).filter("size > 1").select(
        "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    left = F.expr("substring_index(phrase, ' ', k)")
    cut = cut.withColumn("left", left).withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(counts.select("lang", F.col("phrase").alias(side), F.col("a").alias(name)), ["lang", side])
    cut = cut.join(totals, "lang").withColumns({f"{c}_": _whole(c) for c in "alrn"})
    cut = cut.withColumn("score", F.expr("(1000 * a_ * n_) div (l_ * r_)").cast("long"))
    least = F.min(F.struct("score", "k", "l", "r")).alias("least")
    return cut.groupBy("lang", "phrase", "a", "n").agg(least).select(
        "lang", "phrase", "a", "least.l", "least.r", "n", "least.score"
    )


def _inside_longer(counts: DataFrame, most_words: int) -> DataFrame:
    """(lang, phrase) of phrases that a longer one of the same count holds, and perhaps of others that are no phrases."""
    words = counts.select("lang", "a", F.split("phrase", " ").alias("words")).filter("size(words) > 2")
    spans = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1),"
        " i -> array_join(slice(words, i, m), ' '))))"
    )
    inner = words.select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "a")
    return inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(
    docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP
) -> DataFrame:
    """The first `top` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    Texts are taken in small letters (A-Z only), cut into pieces at full stops, commas, semicolons, colons, exclamation and
    question marks and line ends, and into words at spaces and tabs. A phrase has 2 to 5 words and occurs `least` times or
    more in its language. `score` is the lowest of floor(1000 * a * n / (l * r)) over its cuts, `l` and `r` how often the
    parts occur; of equal scores the first cut counts. Phrases inside a longer one that is as frequent are left out.

    A null text counts as empty, a null language as `und`. Rows may repeat: each counts. A text of any length is read
    whole, in blocks. Other columns, whatever their names, are not looked at. Without frequent phrases the result is empty.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shelf = Shelf(spark, "collocations")
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        filled(F.col(f"`{text_col}`")).cast("binary").alias("text"),
    )
    words = _survivors(texts, shelf, range(1, 2), least, None)
    pairs = _survivors(texts, shelf, range(2, 3), least, bitmap_of(words))
    longer = _survivors(texts, shelf, range(3, MOST_WORDS + 1), least, bitmap_of(pairs))
    counts = phrase_counts(texts, shelf, words.unionByName(pairs).unionByName(longer))
    counts = counts.filter((F.col("a") >= least) | (F.length("phrase") == 0))
    counts = shelf.put(counts.select(F.col("lang").cast("string"), F.col("phrase").cast("string"), "a"), "counts")
    totals = counts.filter("phrase = ''").select("lang", F.col("a").alias("n"))
    frequent = counts.filter("phrase != ''")
    held = _inside_longer(frequent, MOST_WORDS)
    open_ = scored(frequent, totals).join(held, ["lang", "phrase"], "left").filter("longer is null or longer < a")
    open_ = shelf.put(open_.drop("longer"), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First in buckets of each language, so that no task sorts all phrases of a language, then among their first rows.
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))).orderBy(*order)
    all_ = Window.partitionBy("lang").orderBy(*order)
    first = open_.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(all_).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
