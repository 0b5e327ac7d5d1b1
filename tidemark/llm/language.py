"""Language identification of mixed texts: script ranges, per-word scores, and Viterbi with a switching penalty.

Each word is scored for the languages that write its script, by its hashed character n-grams. Over the words of a text
the best sequence of languages is found, where every change of language costs a penalty, so that single odd words do not
break a span but a passage in another language becomes one. A text's language is the one of most of its letters.

The n-gram counts come from a bounded sample of each language's documents and are broadcast: a fixed number of columns for
each language. Texts are labelled in the tasks that hold them, many side by side; there is no shuffle of texts.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.batches import bounded_batches, slices
from tidemark.llm.text import fold, smallest_hashes

#: Documents of each language that are learned from, at most: those with the smallest hash of their id.
MOST_LEARNED = 400
COLUMNS = 1 << 16
ORDERS = (1, 2, 3, 4)
SWITCH = 8.0
#: No word speaks against a language by more than this.
MOST_AGAINST = 6.0
SMOOTHING = 0.1
#: A language writes a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.01
BATCH_BYTES = 12 << 20
MOST_REMEMBERED = 300_000
PIECE = 1 << 20
WORDS_AT_ONCE = 300_000
UNKNOWN = "und"

# First code points of ranges, and the script of the letters from there to the next.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "other"), (0x08A0, "Arabic"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"),
    (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1200, "Ethiopic"), (0x13A0, "other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "other"),
    (0x1C80, "Cyrillic"), (0x1C90, "Georgian"), (0x1CC0, "other"), (0x1D00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"),
    (0x2C00, "other"), (0x2C60, "Latin"), (0x2C80, "other"), (0x2DE0, "Cyrillic"), (0x2E80, "Han"), (0x3040, "Kana"),
    (0x3100, "Han"), (0x3130, "Hangul"), (0x31A0, "Han"), (0x31F0, "Kana"), (0x3200, "Han"), (0xA000, "other"),
    (0xA640, "Cyrillic"), (0xA6A0, "other"), (0xA720, "Latin"), (0xA800, "other"), (0xAC00, "Hangul"), (0xD800, "other"),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "other"), (0xFE70, "Arabic"),
    (0xFF00, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "other"), (0x20000, "Han"), (0x32000, "other"),
)
_STARTS = [start for start, _ in SCRIPTS]
SCRIPT_NAMES = tuple(dict.fromkeys(name for _, name in SCRIPTS))
_SCRIPT_AT = [SCRIPT_NAMES.index(name) for _, name in SCRIPTS]

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Iterator[list[str]]:
    """Runs of letters in small letters, in lists of bounded size: texts are cut at white space."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = re.compile(r"\s").search(text, end)
            end = cut.start() if cut else len(text)
        yield _WORD.findall(text[at:end].lower())
        at = end


def script_of(word: str) -> int:
    """Position in `SCRIPT_NAMES` of the script of a word's first letter."""
    return _SCRIPT_AT[bisect_right(_STARTS, ord(word[0])) - 1]


def n_grams(words: Sequence[str], columns: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the word of every n-gram, its ends marked, and the n-gram's column."""
    points = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), sizes)
    mixed = np.zeros(len(points), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        n = len(points) - order + 1
        if n <= 0:
            return
        mixed = (mixed[:n] * np.uint64(0x100000001B3)) ^ (points[order - 1 :] * np.uint64(0x9E3779B97F4A7C15))
        if order in ORDERS:
            inside = word[:n] == word[order - 1 :]
            column = ((mixed[inside] ^ (mixed[inside] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
            yield word[:n][inside], (column % np.uint64(columns)).astype(np.int64)


@dataclass(frozen=True)
class Languages:
    """What is broadcast: names in code-point order, log-likelihoods by column, and the scripts each is written in."""

    names: tuple[str, ...]
    likelihood: np.ndarray
    writes: np.ndarray


def learn(counted: Sequence[tuple[str, np.ndarray, np.ndarray]]) -> Languages:
    """From each language's n-gram counts by order and column, and its letters by script."""
    counted = sorted(counted, key=lambda c: c[0])
    tables = []
    for _, grams, _ in counted:
        smooth = grams + SMOOTHING
        tables.append(np.log(smooth / smooth.sum(axis=1, keepdims=True)))
    # Order, column, language.
    likelihood = np.stack(tables, axis=2).astype(np.float32) if tables else np.zeros((len(ORDERS), 0, 0), np.float32)
    writes = np.array([letters >= SCRIPT_SHARE * max(1, letters.sum()) for _, _, letters in counted], bool)
    return Languages(tuple(name for name, _, _ in counted), likelihood, writes.reshape(len(counted), len(SCRIPT_NAMES)))


class WordScores:
    """Scores of words for each language, at most 0; remembers words up to a bound."""

    def __init__(self, languages: Languages, most: int = MOST_REMEMBERED):
        self.languages, self.most = languages, most
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.scores = np.zeros((self.most, len(self.languages.names)), np.float32)
        self.letters = np.zeros(self.most, np.int64)

    def learn(self, words: list[str]) -> None:
        known = self.languages
        scores = np.zeros((len(words), len(known.names)), np.float32)
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            for order, (word, column) in enumerate(n_grams(part, known.likelihood.shape[1])):
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                # Orders overlap: together they count as one.
                scores[at + word[first]] += np.add.reduceat(known.likelihood[order][column], first, axis=0) / len(ORDERS)
        writes = known.writes[:, [script_of(w) for w in words]].T if words else np.zeros((0, len(known.names)), bool)
        # Where no language writes a word's script, the word says nothing.
        some = writes.any(axis=1, keepdims=True)
        scores = np.where(some, np.where(writes, scores, -np.inf), 0)
        scores = np.maximum(scores - scores.max(axis=1, keepdims=True, initial=-np.inf), -MOST_AGAINST)
        letters = np.array([len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words], np.int64)
        scores[letters == 0] = 0
        have, need = len(self.place), len(self.place) + len(words)
        if need > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros((need, scores.shape[1]), np.float32)])
            self.letters = np.concatenate([self.letters, np.zeros(need, np.int64)])
        self.scores[have:need], self.letters[have:need] = scores, letters
        self.place.update(zip(words, range(have, need)))


def best_sequences(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word, of texts that lie one behind the other, by Viterbi side by side."""
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    longest, first = int(sizes.max(initial=0)), starts[order]
    active = np.searchsorted(-sizes[order], -np.arange(longest), side="left")
    total = np.zeros((len(sizes), scores.shape[1]), np.float32)
    switched, source = [], []
    for t in range(longest):
        n = active[t]
        own = total[:n]
        best = own.argmax(axis=1)
        change = own[np.arange(n), best][:, None] - np.float32(penalty)
        move = change > own
        total[:n] = np.where(move, change, own) + scores[first[:n] + t]
        switched.append(move)
        source.append(best.astype(np.int16))
    out = np.zeros(len(scores), np.int16)
    state = total.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        out[first[:n] + t] = state[:n]
        if t:
            at = np.arange(n)
            state[:n] = np.where(switched[t][at, state[:n]], source[t], state[:n])
    return out


@dataclass
class Labelled:
    """Words of some texts, one behind the other, with the language each is labelled with."""

    sizes: np.ndarray
    letters: np.ndarray
    labels: np.ndarray


def label(texts: Sequence[str], scorer: WordScores, penalty: float) -> Labelled:
    """Label every word of each text."""
    parts, sizes, scores, letters = [], [], [], []

    def turn() -> None:
        """Look up what is held before the scorer forgets its words."""
        if parts:
            flat = np.concatenate(parts)
            scores.append(scorer.scores[flat])
            letters.append(scorer.letters[flat])
            parts.clear()

    def place(lists: list[list[str]]) -> None:
        """Find the words of some lists, learning the new ones all at once."""
        words = set().union(*lists)
        new = words - scorer.place.keys()
        if len(scorer.place) + len(new) > scorer.most:
            turn()
            scorer.clear()
            new = words
        if new:
            scorer.learn(sorted(new))
        parts.extend(np.fromiter(map(scorer.place.__getitem__, x), np.int64, len(x)) for x in lists)

    lists, held = [], 0
    for text in texts:
        n = 0
        for words in words_of(text):
            lists.append(words)
            n += len(words)
            held += len(words)
            if held >= WORDS_AT_ONCE:
                place(lists)
                lists, held = [], 0
        sizes.append(n)
    place(lists)
    turn()
    flat = np.concatenate(scores) if scores else np.zeros((0, len(scorer.languages.names)), np.float32)
    counts = np.array(sizes, np.int64)
    labels = best_sequences(flat, counts, penalty) if len(flat) else np.zeros(0, np.int16)
    return Labelled(counts, np.concatenate(letters) if letters else np.zeros(0, np.int64), labels)


def _sample(docs: DataFrame, most: int) -> DataFrame:
    """At most `most` documents of each language; chosen by id alone, so that no texts are sorted."""
    taught = docs.filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~fold(F.col("id")))
    chosen = smallest_hashes(taught.select("id", "lang").distinct(), "lang", ["id"], most).drop("place")
    texts = docs.filter(F.col("text").isNotNull()).join(chosen.hint("broadcast"), ["id", "lang"])
    # Of rows that repeat an id one text counts.
    return texts.groupBy("id", "lang").agg(F.min("text").alias("text"))


def _counted(sample: DataFrame, columns: int) -> DataFrame:
    def count(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        grams, letters = np.zeros((len(ORDERS), columns), np.int64), np.zeros(len(SCRIPT_NAMES), np.int64)
        for text in frame["text"]:
            for words in words_of(text):
                words = [w for w in words if w.isalpha()]
                for order, (_, column) in enumerate(n_grams(words, columns)):
                    grams[order] += np.bincount(column, minlength=columns)
                for w in words:
                    letters[script_of(w)] += len(w)
        return pd.DataFrame({"lang": [key[0]], "grams": [grams.ravel()], "letters": [letters]})

    return sample.groupBy("lang").applyInPandas(count, "lang string, grams array<long>, letters array<long>")


def identify(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    most_learned: int = MOST_LEARNED,
    columns: int = COLUMNS,
    switch: float = SWITCH,
    spans: bool = False,
) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score, and with `spans` the array of (lang, start, end).

    Learned are text and lang of documents with an id, a text and a lang outside the held-out fold, at most `most_learned`
    for each language, of any script. A prediction depends on the text alone. `score` is the share of the text's letters
    that are labelled lang_pred; of languages with as many letters the first in code-point order is predicted. A null
    text, or one without letters, is `und` with score 0, as is every text if nothing could be learned. Spans count words,
    runs of letters, end exclusive. Ids may be null (never held out) or repeated; without rows the result is empty. Other
    columns of `docs`, whatever their names, are not looked at.
    """
    given = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    )
    bounded_batches(docs.sparkSession)
    # One row of a fixed number of counts for each language.
    rows = _counted(_sample(given, most_learned), columns).collect()
    shape = (len(ORDERS), columns)
    counted = [(r["lang"], np.array(r["grams"]).reshape(shape), np.array(r["letters"])) for r in rows]
    sent = docs.sparkSession.sparkContext.broadcast(learn(counted))
    kind = T.ArrayType(T.StructType().add("lang", "string").add("start", "long").add("end", "long"))
    schema = T.StructType([T.StructField("doc_id", given.schema["id"].dataType)])
    schema = schema.add("held_out", "boolean").add("lang_pred", "string").add("score", "double")
    if spans:
        schema = schema.add("spans", kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = sent.value
        scorer = WordScores(languages)
        # Every word has a score for each language: the more there are, the fewer texts at a time.
        for part in slices(batches, "text", BATCH_BYTES * 4 // max(4, len(languages.names))):
            texts = [t or "" for t in part.column("text").to_pylist()]
            predicted, shares, found = [], [], []
            done = label(texts if languages.names else [""] * len(texts), scorer, switch)
            owner = np.repeat(np.arange(len(texts)), done.sizes)
            votes = np.zeros((len(texts), max(1, len(languages.names))))
            np.add.at(votes, (owner, done.labels), done.letters)
            letters = votes.sum(axis=1)
            best = votes.argmax(axis=1)
            for i, b in enumerate(best):
                predicted.append(languages.names[b] if letters[i] else UNKNOWN)
                shares.append(votes[i, b] / letters[i] if letters[i] else 0.0)
            out = [part.column("doc_id"), part.column("held_out"), pa.array(predicted, pa.string()), pa.array(shares)]
            if spans:
                ends = np.cumsum(done.sizes)
                for a, b in zip(ends - done.sizes, ends):
                    own = done.labels[a:b]
                    cuts = [*np.flatnonzero(np.diff(own, prepend=-1)).tolist(), b - a]
                    found.append([(languages.names[own[x]], x, y) for x, y in zip(cuts, cuts[1:])])
                fields = [{"lang": lang, "start": x, "end": y} for f in found for lang, x, y in f]
                flat = pa.array(fields, pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                out.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), flat))
            yield pa.RecordBatch.from_arrays(out, schema.names)

    asked = given.select(F.col("id").alias("doc_id"), fold(F.col("id")).alias("held_out"), "text")
    return asked.mapInArrow(run, schema)
