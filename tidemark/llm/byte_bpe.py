"""Byte-level BPE encoding and decoding, by corpus-level merge replay.

The distinct pre-tokens of a batch of documents lie one behind the other in arrays of symbols and neighbours. An inverted
index leads from a pair, named by the rank of the symbol it merges to, to the positions where it stands. The merges are
replayed in rank order: each takes its positions from the index, merges them all at once, and enters only the pairs that
its neighbours now form. Texts are cut where white space begins, which is always a border of pre-tokens, and the ids of
such pieces are remembered up to a bound. Encoding and decoding need no shuffle.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.batches import bounded_batches, gathered, give_back, text_bytes

BATCH_BYTES = 2 << 20
MOST_REMEMBERED = 200_000
DECODE_ROWS = 256
#: Positions whose first pairs are looked up at once, and ids that are decoded at once: what such a step holds is bounded.
ENTERED = 1 << 18
DECODED = 1 << 16
#: Up to so many positions of one merge are cheaper one by one than as arrays.
FEW = 6

NO_RANK = np.iinfo(np.int32).max

# The code points with the Unicode property White_Space.
_WHITE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


@dataclass(frozen=True)
class ByteBpe:
    """Tokens by id and the ranked pairs, small enough to be sent to every executor (a few entries per token)."""

    pattern: str
    tokens: dict[int, bytes]
    first: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    width: int


def load_byte_bpe(path: str, pattern: str) -> ByteBpe:
    """Read a file of lines `base64(token) rank`; `pattern` splits texts into pre-tokens."""
    with open(path, "rb") as f:
        rank = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
    if any(bytes([b]) not in rank for b in range(256)):
        raise ValueError(f"{path} lacks single bytes")
    width = max(rank.values()) + 1
    pairs = {
        rank[t[:i]] * width + rank[t[i:]]: r
        for t, r in rank.items()
        for i in range(1, len(t))
        if t[:i] in rank and t[i:] in rank
    }
    keys = np.fromiter(pairs, np.int64, len(pairs))
    order = np.argsort(keys)
    ranks = np.fromiter(pairs.values(), np.int32, len(pairs))[order]
    first = np.array([rank[bytes([b])] for b in range(256)], np.int32)
    return ByteBpe(pattern, {r: t for t, r in rank.items()}, first, keys[order], ranks, width)


class Replay:
    """The symbols of many words, and the index from each pair to its positions."""

    def __init__(self, words: Sequence[bytes], bpe: ByteBpe):
        self.words, self.bpe = words, bpe
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(lengths)
        n = int(self.ends[-1])
        self.symbol = bpe.first[np.frombuffer(b"".join(words), np.uint8)]
        kind = np.int32 if n < 2**31 else np.int64
        self.after = np.arange(1, n + 1, dtype=kind)
        self.after[self.ends - 1] = -1
        self.before = np.arange(-1, n - 1, dtype=kind)
        self.before[self.ends - lengths] = -1
        self.index: dict[int, list[np.ndarray]] = {}
        self.due: list[int] = []
        self.early: set[int] = set()

    def run(self) -> list[bytes]:
        """The ids of each word, as the bytes of 32-bit integers."""
        last = len(self.symbol) - 1
        for at in range(0, last, ENTERED):
            self._enter(np.arange(at, min(at + ENTERED, last), dtype=self.after.dtype), -1)
        while self.due:
            rank = heapq.heappop(self.due)
            at = self.index.pop(rank)
            self._merge(rank, np.concatenate(at) if len(at) > 1 else at[0])
        kept = self.symbol >= 0
        ends = (4 * np.cumsum(kept)[self.ends - 1]).tolist()
        flat = self.symbol[kept].astype(np.int32).tobytes()
        ids = [flat[a:b] for a, b in zip([0, *ends], ends)]
        for w in self.early:
            ids[w] = np.array(one_by_one(self.words[w], self.bpe), np.int32).tobytes()
        return ids

    def _ranks(self, at: np.ndarray) -> np.ndarray:
        """Rank of the pair at each position whose symbol has one after it."""
        keys = self.symbol[at] * np.int64(self.bpe.width) + self.symbol[self.after[at]]
        found = np.minimum(np.searchsorted(self.bpe.keys, keys), len(self.bpe.keys) - 1)
        return np.where(self.bpe.keys[found] == keys, self.bpe.ranks[found], NO_RANK)

    def _enter(self, at: np.ndarray, rank: int) -> None:
        """Enter the pairs at these positions into the index."""
        at = at[self.after[at] >= 0]
        ranks = self._ranks(at)
        known = ranks != NO_RANK
        at, ranks = at[known], ranks[known]
        if not len(at):
            return
        # A pair that should have come before this merge's other positions: that word is done by single merges.
        lower = ranks < rank
        if lower.any():
            self.early.update(np.searchsorted(self.ends, at[lower], side="right").tolist())
        if len(at) > FEW:
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            parts, heads = np.split(at, cuts), ranks[np.r_[0, cuts]].tolist()
        else:
            parts, heads = [at[i : i + 1] for i in range(len(at))], ranks.tolist()
        for head, part in zip(heads, parts):
            listed = self.index.get(head)
            if listed is None:
                self.index[head] = [part]
                heapq.heappush(self.due, head)
            else:
                listed.append(part)

    def _merge(self, rank: int, at: np.ndarray) -> None:
        """Merge the pair of this rank wherever it still stands."""
        if len(at) > 1:
            at = np.sort(at)
            at = at[np.r_[True, at[1:] != at[:-1]]]
        at = at[(self.symbol[at] >= 0) & (self.after[at] >= 0)]
        at = at[self._ranks(at) == rank]
        second = self.after[at]
        if len(at) > 1 and (second[:-1] == at[1:]).any():
            at = self._apart(at)
            second = self.after[at]
        if not len(at):
            return
        self.symbol[at], self.symbol[second] = rank, -1
        beyond = self.after[second]
        self.after[at] = beyond
        inner = beyond >= 0
        self.before[beyond[inner]] = at[inner]
        left = self.before[at]
        self._enter(np.concatenate([left[left >= 0], at]), rank)

    def _apart(self, at: np.ndarray) -> np.ndarray:
        """Of pairs that share a symbol, as in a run of one symbol, every second, from the left."""
        taken, used = [], -1
        for p, q in zip(at.tolist(), self.after[at].tolist()):
            if p != used:
                taken.append(p)
                used = q
        return np.array(taken, at.dtype)


def one_by_one(word: bytes, bpe: ByteBpe) -> list[int]:
    """The same ids by single merges, lowest rank first, then leftmost."""
    symbols = [int(bpe.first[b]) for b in word]
    while len(symbols) > 1:
        flat = np.array(symbols, np.int64)
        keys = flat[:-1] * bpe.width + flat[1:]
        found = np.minimum(np.searchsorted(bpe.keys, keys), len(bpe.keys) - 1)
        ranks = np.where(bpe.keys[found] == keys, bpe.ranks[found], NO_RANK)
        at = int(ranks.argmin())
        if ranks[at] == NO_RANK:
            break
        symbols[at : at + 2] = [int(ranks[at])]
    return symbols


class Encoder:
    """Encodes texts; remembers the ids of up to `most` pieces, as the bytes of 32-bit integers."""

    def __init__(self, bpe: ByteBpe, most: int = MOST_REMEMBERED):
        self.bpe, self.most = bpe, most
        self.pre_tokens = regex.compile(bpe.pattern)
        self.before_space = [w + " " for w in _WHITE]
        self.pieces = regex.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
        #: Ids of pieces that follow a single space, without that space, and of pieces as they stand.
        self.spaced: dict[str, bytes] = {}
        self.plain: dict[str, bytes] = {}

    def cut(self, text: str) -> tuple[list[str], list[str]]:
        """Pieces as they stand, then pieces behind a single space each."""
        if text[:1] == " " or text[-1:] in _WHITE or any(w in text for w in self.before_space):
            return self.pieces.findall(text), []
        parts = text.split(" ")
        return parts[:1] if parts[0] else [], parts[1:]

    def learn(self, plain: set[str], spaced: set[str]) -> None:
        # Letters behind a space are one pre-token; with a full stop or a comma behind them they are two.
        simple = [p for p in spaced if p.isalpha()]
        others = [*plain, *(" " + p for p in spaced if not p.isalpha())]
        split = [
            (p[:-1], p[-1]) if p[-1] in ",." and p[1:-1].isalpha() and p[0] == " " else self.pre_tokens.findall(p)
            for p in others
        ]
        parts = list({w for ws in split for w in ws})
        ids = Replay([*(b" " + p.encode() for p in simple), *(w.encode() for w in parts)], self.bpe).run()
        self.spaced.update(zip(simple, ids))
        known = dict(zip(parts, ids[len(simple) :]))
        joined = [b"".join([known[w] for w in ws]) for ws in split]
        self.plain.update(zip(plain, joined))
        self.spaced.update(zip((p[1:] for p in others[len(plain) :]), joined[len(plain) :]))

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text, as 32-bit integers."""
        plain, spaced = set(), set()
        for t in texts:
            a, b = self.cut(t)
            plain.update(a)
            spaced.update(b)
        unseen = sum(p not in self.plain for p in plain) + sum(p not in self.spaced for p in spaced)
        if len(self.plain) + len(self.spaced) + unseen > self.most:
            # Before others are learnt, those go that these texts do not have.
            self.plain = {p: self.plain[p] for p in plain if p in self.plain}
            self.spaced = {p: self.spaced[p] for p in spaced if p in self.spaced}
        plain.difference_update(self.plain)
        spaced.difference_update(self.spaced)
        if plain or spaced:
            self.learn(plain, spaced)
        out = []
        for t in texts:
            a, b = self.cut(t)
            out.append(b"".join([*map(self.plain.__getitem__, a), *map(self.spaced.__getitem__, b)]))
        return out


def _encoded(batches: Iterator[pa.RecordBatch], bpe: ByteBpe) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """Ids of documents with the lists of their tokens' ids, some rows at a time."""
    encoder = Encoder(bpe)
    for parts in gathered(batches, "text", BATCH_BYTES):
        texts = [t.decode("utf-8", "replace") for p in parts for t in text_bytes(p.column("text"))]
        ids, at = encoder.encode(texts), 0
        for p in parts:
            rows = ids[at : at + p.num_rows]
            at += p.num_rows
            ends = np.cumsum([0, *map(len, rows)]) // 4
            flat = pa.array(np.frombuffer(b"".join(rows), np.int32))
            yield p.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
    del encoder
    give_back()


def _token_bytes(bpe: ByteBpe) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens by id, one behind the other, and where each begins."""
    listed = [bpe.tokens.get(i, b"") for i in range(max(bpe.tokens) + 1)]
    return np.frombuffer(b"".join(listed), np.uint8), np.cumsum([0, *map(len, listed)])


def _decoded(lists: pa.ListArray, flat: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes of each list of ids; a null list gives null, an id not in the vocabulary fails."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    if len(ids) and not (0 <= ids.min() and ids.max() < len(starts) - 1 and np.diff(starts)[ids].all()):
        raise ValueError("an id is not in the vocabulary")
    content, ends = decode_arrays(ids, np.r_[0, np.cumsum(sizes)], flat, starts)
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(content)]
    decoded = pa.Array.from_buffers(pa.binary(), len(lists), buffers)
    return pc.if_else(lists.is_valid(), decoded, pa.scalar(None, pa.binary()))


def _given(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`encode` and `decode` in one task: doc_id, ids and decoded. The ids go to the JVM once, and one worker does both."""
    bpe = load_byte_bpe(vocabulary, pattern)
    sent = docs.sparkSession.sparkContext.broadcast((bpe, _token_bytes(bpe)))
    given = _given(docs, id_col, text_col)
    fields = [given.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, (flat, starts) = sent.value
        for doc_ids, lists in _encoded(batches, bpe):
            for at in range(0, len(lists), DECODE_ROWS):
                part = lists.slice(at, DECODE_ROWS)
                columns = [doc_ids.slice(at, DECODE_ROWS), part, _decoded(part, flat, starts)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return given.mapInArrow(run, T.StructType(fields))


def encode(docs: DataFrame, vocabulary: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id and `ids`, the array of token ids of the whole text, without special tokens.

    A null or empty text has no ids; ids of documents may be null or repeated; a text of any length is read whole.
    Other columns of `docs`, whatever their names, are not looked at. Without rows the result is empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(load_byte_bpe(vocabulary, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, lists in _encoded(batches, sent.value):
            yield pa.RecordBatch.from_arrays([doc_ids, lists], ["doc_id", "ids"])

    given = _given(docs, id_col, text_col)
    return given.mapInArrow(run, T.StructType([given.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode_arrays(ids: np.ndarray, ends: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ids, one behind the other, and where each row's end; `starts` has the place of each token in `flat`."""
    lengths = np.diff(starts)[ids].astype(np.int32)
    until = np.cumsum(lengths, dtype=np.int64)
    content = np.empty(int(until[-1]) if len(until) else 0, np.uint8)
    for at in range(0, len(ids), DECODED):
        part, n = until[at : at + DECODED], lengths[at : at + DECODED]
        first, last = int(until[at - 1]) if at else 0, int(part[-1])
        places = np.repeat(starts[ids[at : at + DECODED]] - part + n, n)
        places += np.arange(first, last)
        content[first:last] = flat[places]
    row_ends = np.zeros(len(ends), np.int64)
    some = ends > 0
    row_ends[some] = until[ends[some] - 1]
    return content, row_ends


def decode(encoded: DataFrame, vocabulary: str, pattern: str, *, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """`encoded` with the bytes of its ids as the binary column `to`; null ids give null, an id not in the vocabulary fails.

    All columns are kept; one that is named `to` is replaced. Without rows the result is empty.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(_token_bytes(load_byte_bpe(vocabulary, pattern)))
    schema = T.StructType([f for f in encoded.schema if f.name != to] + [T.StructField(to, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, starts = sent.value
        for batch in (b.slice(i, DECODE_ROWS) for b in batches for i in range(0, b.num_rows, DECODE_ROWS)):
            decoded = _decoded(batch.column(ids_col), flat, starts)
            columns = {f.name: batch.column(f.name) for f in schema if f.name != to}
            yield pa.RecordBatch.from_pydict(columns | {to: decoded})

    return encoded.mapInArrow(run, schema)
