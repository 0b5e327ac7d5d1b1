"""Secret scans: patterns of known kinds, and a token-efficiency test for random strings.

A vocabulary made for text spends few tokens on words and many on random strings. Runs of letters, digits and the signs of
Base64 that get fewer than `least_ratio` characters per token are reported as `random`, unless they are digests by their
length, UUIDs, numbers without a letter, lists of single letters, or identifiers whose own words are token-efficient. All
of a text is read, in the task that holds it; no shuffle.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.batches import slices

KINDS = ("assign", "access", "hex", "random")
LEAST_RATIO = 2.0
#: Measured: at 16 characters the test adds 6 runs of clean text on the 24.8 million characters of sf0.1, at 12 some 500.
LEAST_CHARS = 16
SLICE_BYTES = 4 << 20

ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")

# Hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_HEX_ONLY = re.compile(r"[0-9A-Fa-f]+")
#: Words and numbers, or words that end in a number, between signs.
_NAME = re.compile(r"[-+/_=]*(?:(?:[A-Za-z]+[0-9]{0,3}|[0-9]+)[-+/_=]+)*(?:[A-Za-z]+[0-9]{0,3}|[0-9]+)?")

_WORDS = re.compile(r"[A-Za-z]+")
_LETTERS_LISTED = re.compile(r"[-+/_=]*(?:[A-Za-z][-+/_=]+)+[A-Za-z]?")

_SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    )
)


class Scanner:
    def __init__(self, ranks: dict[bytes, int], pattern: str, least_ratio: float, least_chars: int):
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.least_ratio, self.least_chars = least_ratio, least_chars
        self.runs = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{least_chars},}}")

    def is_random(self, run: str) -> bool:
        """Whether the run has letters, is no digest or identifier, and takes many tokens."""
        if not any(map(str.isalpha, run)):
            return False
        if len(run) in DIGEST_LENGTHS and _HEX_ONLY.fullmatch(run) or _UUID.fullmatch(run) or _LETTERS_LISTED.fullmatch(run):
            return False
        if not self.is_wasteful([run]):
            return False
        if not _NAME.fullmatch(run):
            return True
        words = _WORDS.findall(run)
        return self.is_wasteful(words) and (len(words) == 1 or self.is_wasteful([w.lower() for w in words]))

    def is_wasteful(self, pieces: list[str]) -> bool:
        """Whether the pieces have fewer characters per token than text has."""
        tokens = sum(len(self.encoding.encode_ordinary(p)) for p in pieces)
        return sum(map(len, pieces)) < self.least_ratio * tokens

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """All spans by start, then kind in the order of `KINDS`."""
        found = [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        low = text.lower()
        if "passw" in low or "secret" in low or "token" in low or "api" in low:
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
        # Runs lie between white space, so texts without a long enough piece have none.
        longest = max(map(len, text.split()), default=0)
        if longest >= 24:
            found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
        if longest >= self.least_chars:
            base, at, until = sorted(found), 0, -1
            for m in self.runs.finditer(text):
                # Both lists ascend: `until` is the farthest end of the base spans that begin before the run or with it.
                while at < len(base) and base[at][0] <= m.start():
                    until = max(until, base[at][2])
                    at += 1
                if m.end() > until and self.is_random(m.group()):
                    found.append((m.start(), 3, m.end()))
        return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def scan_secrets(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_ratio: float = LEAST_RATIO,
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """One row per row of `docs`: doc_id and `spans`, an array of (kind, start, end) in code points, end exclusive.

    Spans are ordered by start, then kind. `assign` is a whole assignment whose value has 6 characters or more, `access` a key
    id of 20 or more, `hex` a run of 24 or more; matches of a kind do not overlap. `random` is what the token test adds
    outside of these, among runs of `least_chars` or more, with or without digits; shorter ones are not looked at. A null or empty text has no spans; ids may be null or repeated. Without rows the result is empty. Other
    columns of `docs`, whatever their names, are not looked at.
    """
    # One entry per token of the vocabulary.
    sent = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    given = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([given.schema["doc_id"], T.StructField("spans", _SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(sent.value, pattern, least_ratio, least_chars)
        for part in slices(batches, "text", SLICE_BYTES):
            ends, kinds, starts, stops = [0], [], [], []
            for text in part.column("text").to_pylist():
                for kind, a, b in scanner.spans(text or ""):
                    kinds.append(kind)
                    starts.append(a)
                    stops.append(b)
                ends.append(len(kinds))
            flat = pa.StructArray.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64())],
                ["kind", "start", "end"],
            )
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "spans"])

    return given.mapInArrow(run, schema)
