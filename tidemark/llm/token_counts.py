"""Token counts of a BPE vocabulary with word ends, by rank-synchronous array merging.

Texts are split at white space, which no token crosses, and a text's count is the sum over its chunks. Chunks not seen
before are normalised, split into pre-tokens, and all pre-tokens of a batch are held as one ragged array of symbol ids.
In each round every pre-token's lowest-ranked pair is merged, all pre-tokens at once, until none has a pair with a rank;
the symbols that survive are counted. Counts of chunks are remembered up to a bound. There is no shuffle.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.batches import slices, text_bytes

LIMIT = 2048
SLICE_BYTES = 4 << 20
MOST_REMEMBERED = 800_000

NO_RANK = np.iinfo(np.int32).max


@dataclass(frozen=True)
class WordBpe:
    """What the vocabulary file says, small enough to be sent to every executor (one entry per merge)."""

    pattern: str
    special: tuple[str, ...]
    inner: np.ndarray
    last: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    width: int


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else the next free code from 256."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in own else next(free)) for b in range(256)]


def load_word_bpe(path: str) -> WordBpe:
    """Read a vocabulary file; only the kind with lower case, byte letters and word ends is understood."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    steps = [n["type"] for n in told["normalizer"]["normalizers"]]
    split, letters = told["pre_tokenizer"]["pretokenizers"]
    end = told["model"]["end_of_word_suffix"]
    if steps != ["NFC", "Replace", "Lowercase"] or letters["type"] != "ByteLevel" or not end or not split["invert"]:
        raise ValueError(f"{path} is not a lower-case byte-level BPE with word ends")
    ids = told["model"]["vocab"]
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in told["model"]["merges"]]
    width = max(ids.values()) + 1
    keys = np.array([ids[a] * width + ids[b] for a, b in pairs], np.int64)
    merged = np.array([ids[a + b] for a, b in pairs], np.int32)
    order = np.argsort(keys, kind="stable")
    return WordBpe(
        split["pattern"]["Regex"],
        tuple(t["content"] for t in told["added_tokens"]),
        np.array([ids[c] for c in byte_letters()], np.int32),
        np.array([ids[c + end] for c in byte_letters()], np.int32),
        keys[order],
        order.astype(np.int32),
        merged[order],
        width,
    )


def surviving_symbols(words: Sequence[bytes], bpe: WordBpe) -> np.ndarray:
    """Number of symbols left of each (non-empty) word after all merges."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbols = bpe.inner[raw]
    symbols[starts + lengths - 1] = bpe.last[raw[starts + lengths - 1]]
    word = np.repeat(np.arange(len(words)), lengths)
    counts = np.zeros(len(words), np.int64)
    ranks, results = _pair_ranks(symbols, word, np.arange(len(symbols)), bpe)
    odd: list[np.ndarray] = []
    while len(symbols):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        size = np.diff(np.r_[first, len(symbols)])
        lowest = np.minimum.reduceat(ranks, first)
        alive = lowest != NO_RANK
        counts[word[first[~alive]]] = size[~alive]
        if not alive.all():
            stay = np.repeat(alive, size)
            symbols, word, ranks, results = symbols[stay], word[stay], ranks[stay], results[stay]
            lowest, size = lowest[alive], size[alive]
            if not len(symbols):
                break
        lowest = np.repeat(lowest, size)
        hit = np.flatnonzero(ranks == lowest)
        hit = _apart(hit)
        symbols[hit] = results[hit]
        left = np.ones(len(symbols), bool)
        left[hit + 1] = False
        moved = np.cumsum(left) - 1
        at = moved[hit]
        symbols, word, ranks, results, lowest = symbols[left], word[left], ranks[left], results[left], lowest[left]
        touched = np.concatenate([at, at[at > 0] - 1])
        ranks[touched], results[touched] = _pair_ranks(symbols, word, touched, bpe)
        # A merge that makes a pair of a lower rank would have to be done before the other merges of this round.
        early = touched[ranks[touched] < lowest[touched]]
        if len(early):
            redo = np.unique(word[early])
            odd.append(redo)
            stay = ~np.isin(word, redo)
            symbols, word, ranks, results = symbols[stay], word[stay], ranks[stay], results[stay]
    for w in np.concatenate(odd) if odd else ():
        counts[w] = _one_by_one(words[w], bpe)
    return counts


def _pair_ranks(symbols, word, at, bpe) -> tuple[np.ndarray, np.ndarray]:
    """Rank and result of the pairs that begin at `at`; no rank at the end of a word or for an unknown pair."""
    after = np.minimum(at + 1, len(symbols) - 1)
    keys = symbols[at].astype(np.int64) * bpe.width + symbols[after]
    found = np.minimum(np.searchsorted(bpe.keys, keys), len(bpe.keys) - 1)
    known = (bpe.keys[found] == keys) & (word[at] == word[after]) & (after > at)
    return np.where(known, bpe.ranks[found], NO_RANK), bpe.merged[found]


def _apart(hit: np.ndarray) -> np.ndarray:
    """Of hits side by side, as in a run of one symbol, every second, from the left."""
    near = np.flatnonzero(np.diff(hit) == 1)
    if not len(near):
        return hit
    run_start = np.r_[True, np.diff(hit) != 1]
    place = np.arange(len(hit))
    return hit[(place - np.maximum.accumulate(np.where(run_start, place, 0))) % 2 == 0]


def _one_by_one(word: bytes, bpe: WordBpe) -> int:
    """The same count by single merges, lowest rank first, then leftmost."""
    symbols = [int(bpe.inner[b]) for b in word[:-1]] + [int(bpe.last[word[-1]])]
    while len(symbols) > 1:
        flat = np.array(symbols, np.int32)
        ranks, results = _pair_ranks(flat, np.zeros(len(flat), np.int8), np.arange(len(flat)), bpe)
        at = int(ranks.argmin())
        if ranks[at] == NO_RANK:
            break
        symbols[at : at + 2] = [int(results[at])]
    return len(symbols)


class ChunkCounter:
    """Counts tokens of texts; remembers the counts of up to `most` chunks."""

    def __init__(self, bpe: WordBpe, most: int = MOST_REMEMBERED):
        self.bpe, self.most, self.seen = bpe, most, {}
        self.pre_tokens = regex.compile(f"{bpe.pattern}|\n")
        self.special = regex.compile("|".join(map(regex.escape, bpe.special)) or "(?!)")

    def learn(self, chunks: list[bytes]) -> None:
        """Count chunks, which hold no line feed, as lines of one text."""
        lines = b"\n".join(chunks).decode("utf-8", "replace")
        extra = np.zeros(len(chunks), np.int64)
        if self.special.search(lines):
            # A special string is one token and ends what stands beside it; it is taken out before lower-casing.
            split = [self.special.split(line) for line in lines.split("\n")]
            extra += [len(parts) - 1 for parts in split]
            lines = "\n".join(" ".join(parts) for parts in split)
        # Lower case by code point: the final form of sigma is a matter of context, which is not looked at.
        found = self.pre_tokens.findall(unicodedata.normalize("NFC", lines).replace("Σ", "σ").lower())
        places = {w: i for i, w in enumerate(dict.fromkeys(found))}
        breaks = places.pop("\n", None)
        kinds = list(places)
        sizes = np.zeros(len(places) + 1, np.int64)
        if kinds:
            sizes[list(places.values())] = surviving_symbols([w.encode() for w in kinds], self.bpe)
        if breaks is not None:
            places["\n"] = breaks
        flat = np.fromiter(map(places.__getitem__, found), np.int64, len(found))
        line = np.cumsum(flat == (-1 if breaks is None else breaks))
        extra += np.bincount(line, weights=sizes[flat], minlength=len(chunks)).astype(np.int64)
        if len(self.seen) + len(chunks) > self.most:
            self.seen.clear()
        self.seen.update(zip(chunks, extra.tolist()))

    def counts(self, texts: list[bytes]) -> list[int]:
        split = [t.split() for t in texts]
        wanted = set().union(*split)
        new = wanted - self.seen.keys()
        if new:
            if len(self.seen) + len(new) > self.most:
                new = wanted
            self.learn(list(new))
        return [sum(map(self.seen.__getitem__, chunks)) for chunks in split]


def count_tokens(
    docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit, as the vocabulary's library counts whole texts.

    A null or empty text has no bytes and no tokens; ids may be null or repeated; a text of any length is read whole.
    Special strings inside texts are one token each. Other columns of `docs`, whatever their names, are not looked at.
    Without rows the result is empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(load_word_bpe(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = ChunkCounter(sent.value)
        for part in slices(batches, "text", SLICE_BYTES):
            n = counter.counts(text_bytes(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    given = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    kind = given.schema["doc_id"].dataType.simpleString()
    counted = given.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
