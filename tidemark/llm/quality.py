"""Quality classifier by nearest-neighbour voting over latent-semantic vectors.

A text's terms are its words in small letters without signs and digits, the shapes of its words, in which a run of small
letters, of capitals, of digits or of one sign is one character, and terms for its length, its repeated words and how
varied its words are. Weighted by frequency and rarity and hashed to a fixed number of columns, those of words apart from
the others, the terms of a bounded sample of labelled documents are factorised; the leading directions span the latent
space. Words and other terms have a fixed share of a text's vector each, so that many rare words do not drown shapes. The sample's vectors and their labels are broadcast (a few thousand rows at most).
Every document is projected in blocks, its cosines with all labelled vectors are computed exactly, and the nearest
vote with weights that grow with their similarity. There is no shuffle of texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.batches import bounded_batches, give_back, text_bytes, white_blocks
from tidemark.llm.text import filled, fold

#: Labelled rows of each label that the classifier is fitted on, at most: those with the smallest hash of their id.
MOST_LABELLED = 2000
COLUMNS = 16384
DIMENSIONS = 96
#: Length of the words' part of a vector, where that of the other terms is 1.
WORDS_LENGTH = 0.5
NEIGHBOURS = 25
SHARPNESS = 8
KEEP_FROM = 0.7
BLOCK = 512
MOST_REMEMBERED = 100_000
LONGEST_REMEMBERED = 64
#: Directions that are iterated besides the wanted ones, and rounds at most.
SPARE = 16
MOST_ROUNDS = 100

#: Bytes beyond ASCII, of which letters with accents are made, stand with the small letters.
_CLASSES = bytes(
    ord("a") if b >= 0x80 or chr(b).islower() else ord("A") if chr(b).isupper() else ord("0") if chr(b).isdigit() else b
    for b in range(256)
)


def word_shapes(text: bytes) -> list[bytes]:
    """The words' shapes: `Aa` for a capital and small letters, `A!` for capitals and any number of exclamation marks."""
    classes = np.frombuffer(text.translate(_CLASSES), np.uint8)
    starts = np.ones(len(classes), bool)
    starts[1:] = classes[1:] != classes[:-1]
    return classes[starts].tobytes().split()


_SMALL = re.compile(rb"[a-z\x80-\xff]+")


def _others(columns: int) -> int:
    """Columns of all terms but words: the first quarter."""
    return max(1, columns // 4)


class Terms:
    """Hashed term columns of texts. The columns of shapes and of words are remembered up to a bound."""

    def __init__(self, columns: int):
        self.others, self.seen, self.seen_words = _others(columns), {}, {}
        self.words = max(1, columns - self.others)

    def column(self, term: bytes) -> int:
        return self._remembered(self.seen, term, self.others, 0)

    def word(self, term: bytes) -> int:
        return self._remembered(self.seen_words, term, self.words, self.others)

    @staticmethod
    def _remembered(seen: dict[bytes, int], term: bytes, columns: int, first: int) -> int:
        found = seen.get(term)
        if found is None:
            found = first + zlib.crc32(term) % columns
            if len(term) <= LONGEST_REMEMBERED:
                if len(seen) >= MOST_REMEMBERED:
                    seen.clear()
                seen[term] = found
        return found

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Columns and weights: the share of each shape and word, damped by the logarithm, and what the text is like as a whole.

        Each column once, with the sum of its weights, so that no text has more entries than there are columns. A long
        text is counted in blocks.
        """
        counts, told, different, n, repeats, last = Counter(), Counter(), set(), 0, 0, None
        for part in white_blocks(text):
            words = part.split()
            if words:
                n += len(words)
                repeats += sum(map(eq, words, words[1:])) + (words[0] == last)
                last = words[-1]
                different.update(words)
            counts.update(word_shapes(part))
            told.update(_SMALL.findall(part.lower()))
        n = max(1, n)
        columns = [self.column(shape) for shape in counts]
        shares = np.fromiter(chain(counts.values(), told.values()), np.float64, len(counts) + len(told))
        weights = np.log1p(100 / n * shares) / np.log(101)
        same = repeats / n
        size, varied = n.bit_length(), len(different) / n
        columns += [
            self.column(b"size %d" % size),
            self.column(b"same %d" % int(same * 4)),
            self.column(b"varied %d %d" % (size // 2, int(varied * 5))),
        ]
        columns[len(counts) : len(counts)] = [self.word(word) for word in told]
        weights = np.concatenate([weights, [0.1, 0.1 if same < 0.25 else 1.0, 0.2]])
        found, back = np.unique(np.array(columns, np.int64), return_inverse=True)
        return found, np.bincount(back, weights, len(found))


def _balanced(columns: np.ndarray, weights: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Weights times rarity, words scaled to their length and all other terms to 1."""
    out = weights * rarity[columns]
    words = columns >= _others(len(rarity))
    for part, length in ((words, WORDS_LENGTH), (~words, 1.0)):
        now = np.sqrt(np.square(out[part]).sum())
        if now > 0:
            out[part] *= length / now
    return out


@dataclass(frozen=True)
class Neighbours:
    """What is broadcast: column weights, the latent space, and the labelled vectors with their labels."""

    rarity: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def _project(rows: Sequence[tuple[np.ndarray, np.ndarray]], rarity: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Unit vectors in the latent space; a text without any direction in it stays zero."""
    out = np.zeros((len(rows), space.shape[1]), np.float32)
    for i, (columns, weights) in enumerate(rows):
        out[i] = _balanced(columns, weights, rarity) @ space[columns]
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, length, out=np.zeros_like(out), where=length > 0)


def leading(gram: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` largest eigenvalues that are not zero and their vectors, by iteration of a subspace until they stay.

    A full decomposition takes several copies of the matrix in the driver's memory.
    """
    n = min(len(gram), most + SPARE)
    space = np.linalg.qr(np.random.default_rng(0).standard_normal((len(gram), n), np.float32))[0]
    before = np.zeros(n)
    for _ in range(MOST_ROUNDS):
        moved = gram @ space
        values, turn = np.linalg.eigh((space.T @ moved).astype(np.float64))
        values, turn = values[::-1], turn[:, ::-1].astype(np.float32)
        vectors = space @ turn
        if np.abs(values - before)[:most].max() <= 1e-5 * values[0]:
            break
        before, space = values, np.linalg.qr(moved @ turn)[0]
    found = np.flatnonzero(values[:most] > 1e-6 * values[0])
    return values[found], vectors[:, found]


def fit(rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, columns: int, dimensions: int) -> Neighbours:
    """The latent space of labelled rows, by the leading eigenvectors of their Gram matrix, and the rows in it."""
    found = np.zeros(columns)
    for at, _ in rows:
        found[np.unique(at)] += 1
    rarity = np.log((1 + len(rows)) / (1 + found)) + 0.1
    used = np.flatnonzero(found)
    place = np.zeros(columns, np.int64)
    place[used] = np.arange(len(used))
    # Of each row the sum in each column, and its length; dense only in blocks of columns.
    sums = [np.unique(place[at], return_inverse=True) for at, _ in rows]
    values = [np.bincount(back, _balanced(at, w, rarity), len(to)) for (at, w), (to, back) in zip(rows, sums)]
    values = [v / max(np.linalg.norm(v), 1e-9) for v in values]
    where = np.repeat(np.arange(len(rows)), [len(v) for v in values])
    to, value = np.concatenate([t for t, _ in sums]), np.concatenate(values).astype(np.float32)
    order = np.argsort(to, kind="stable")
    where, to, value = where[order], to[order], value[order]

    def blocks() -> Iterator[np.ndarray]:
        for first in range(0, len(used), BLOCK):
            a, b = np.searchsorted(to, [first, first + BLOCK])
            block = np.zeros((len(rows), min(BLOCK, len(used) - first)), np.float32)
            block[where[a:b], to[a:b] - first] = value[a:b]
            yield block

    gram = np.zeros((len(rows), len(rows)), np.float32)
    for block in blocks():
        gram += block @ block.T
    strengths, vectors = leading(gram, min(dimensions, len(used)))
    vectors = vectors / np.sqrt(strengths)
    space = np.zeros((columns, len(strengths)), np.float32)
    space[used] = np.concatenate([block.T @ vectors for block in blocks()])
    return Neighbours(rarity, space, _project(rows, rarity, space), labels.astype(np.float64))


def vote(rows: Sequence[tuple[np.ndarray, np.ndarray]], known: Neighbours, neighbours: int, sharpness: float) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, weighted by similarity; the mean label where none is similar."""
    out = np.empty(len(rows))
    k = min(neighbours, len(known.labels))
    for at in range(0, len(rows), BLOCK):
        cosines = _project(rows[at : at + BLOCK], known.rarity, known.space) @ known.vectors.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** sharpness
        total = weights.sum(axis=1)
        voted = (weights * known.labels[near]).sum(axis=1)
        out[at : at + BLOCK] = np.where(total > 0, voted / np.where(total > 0, total, 1), known.labels.mean())
    return np.clip(out, 0, 1)


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label_col: str, most: int, columns: int, id_col: str, text_col: str
) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Terms and labels of the sample: at most `most` rows of each label, one text for each id, none of the held-out fold."""
    label = F.col(f"`{label_col}`")
    known = labels.select(F.col(f"`{id_col}`").alias("id"), label.cast("int").alias("label")).filter(
        label.isin(0, 1) & F.col("id").isNotNull() & ~fold(F.col("id"))
    )
    hashed = known.distinct().orderBy(F.xxhash64("id"), "id")
    sample = hashed.filter("label = 0").limit(most).unionByName(hashed.filter("label = 1").limit(most))
    given = docs.select(F.col(f"`{id_col}`").alias("id"), filled(F.col(f"`{text_col}`")).alias("text"))
    # The sample has at most twice `most` rows. Of rows that repeat an id one text counts.
    texts = given.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("text").alias("text"))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Terms(columns).of
        for batch in batches:
            found = [of(t) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("label"),
                 pa.array([c for c, _ in found], pa.list_(pa.int64())), pa.array([w for _, w in found], pa.list_(pa.float64()))],
                ["id", "label", "columns", "weights"],
            )

    found = texts.mapInArrow(terms, "id string, label int, columns array<long>, weights array<double>").toArrow()
    found = found.sort_by([("label", "ascending"), ("id", "ascending")]).combine_chunks()
    at, weights = (found.column(c).combine_chunks() for c in ("columns", "weights"))
    rows = [(at[i].values.to_numpy(), weights[i].values.to_numpy()) for i in range(found.num_rows)]
    return rows, found.column("label").to_numpy().astype(np.float64)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    text: Column,
    *,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    most_labelled: int = MOST_LABELLED,
    columns: int = COLUMNS,
    dimensions: int = DIMENSIONS,
    neighbours: int = NEIGHBOURS,
    sharpness: float = SHARPNESS,
) -> Column:
    """Fit on labelled rows of `docs` and give the column of scores of `text`, from 0 to 1, higher where label 1 is likelier.

    Learned are `labels` rows with label 0 or 1 outside the held-out fold, at most `most_labelled` of each label, joined to
    their texts by id. A score depends on the text alone. A null or empty text is scored like a text without words.
    Labels that are null or anything else, labels without a document, and null ids teach nothing; an id with both labels
    teaches both. Without any labelled row every score is 0.5.
    """
    bounded_batches(docs.sparkSession)
    rows, known = labelled_rows(docs, labels, label_col, most_labelled, columns, id_col, text_col)
    model = fit(rows, known, columns, dimensions) if rows else None
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of, fitted = Terms(columns).of, sent.value
        for batch in batches:
            if fitted is None:
                yield pd.Series(np.full(len(batch), 0.5))
            else:
                yield pd.Series(vote([of(bytes(t)) for t in batch], fitted, neighbours, sharpness))
        give_back()

    return score(filled(text).cast("binary"))


def classify(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_from: float = KEEP_FROM, **options
) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted (1 from `keep_from`). Ids may be null (never held out)
    or repeated; without rows the result is empty; other columns of `docs`, whatever their names, are not looked at."""
    score = quality_scores(docs, labels, F.col("text"), id_col=id_col, text_col=text_col, **options)
    given = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    scored = given.select("doc_id", fold(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= keep_from).cast("int"))
