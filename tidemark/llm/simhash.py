"""SimHash near-dedup by fuzzy hashing with the Golay code.

Equal fingerprints are one class, and classes are linked if their fingerprints differ in few bits. A fingerprint of 64
bits is cut into segments A and B of 23 bits, one Golay word each, and a rest R of 18. By the pigeonhole principle 4
errors or fewer fall so that

- R is equal, and A or B has at most 2 errors and shares a codeword, or
- A is equal (or B), and B (or A) shares a codeword, or has 3 errors, so that R has one and one of its halves is equal, or
- all three have errors: A and B at most 2, so both share a codeword, and R at most 2, so one of its thirds is equal.

So each class gets about 110 keys of 30 bits or more, linked classes share at least one, and every pair found is
verified. Keys and their members are counted in one shuffle, after which most keys, with one member or two, are done. A key with
many members is not paired off: its members are first linked to one of them and the links closed to components, and then
only members outside the key's largest component are compared with the others. So a dense cluster of near copies
costs in proportion to its members. Keys with few members, at most `FEW`, are paired off directly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import golay
from tidemark.llm.batches import bounded_batches, give_back, white_blocks
from tidemark.llm.components import components
from tidemark.llm.sieve import sieved
from tidemark.llm.text import Shelf, filled

SHINGLE_WORDS = 4
MOST_BITS = 4
SEED = 42
PRINTED_ROWS = 256
#: A longer text is hashed in blocks, whose counts are summed.
BLOCK_BYTES = 1 << 20
FEW = 32
KEYED_ROWS = 2048
REST_BITS = 64 - 2 * golay.BITS


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def long_fingerprint(text: bytes, words: int, seed: int, block: int = BLOCK_BYTES) -> int:
    """SimHash of one text in blocks: each goes on with the last words of the one before."""
    digest, counts, n, carried, whole = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0, [], True
    for part in white_blocks(text, block):
        found = carried + part.lower().split()
        hashes = [digest(b" ".join(found[i : i + words]), seed) for i in range(len(found) - words + 1)]
        if hashes:
            counts += _set_bits(np.array(hashes, "<u8"))
            n, whole = n + len(hashes), False
        carried = found[max(0, len(found) - words + 1) :] if words > 1 else []
    if whole and carried:
        return digest(b" ".join(carried), seed)
    return sum(1 << i for i, c in enumerate(counts.tolist()) if 2 * c > n)


def fingerprints(texts: Sequence[bytes], words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """SimHash of each text: a bit is 1 if it is set in over half the XXH64 of the text's shingles, repeats included.

    Words are runs without white space, A-Z in lower case. Fewer words than a shingle make one shingle, none make 0.
    """
    digest = xxhash.xxh64_intdigest
    hashes, sizes = [], np.zeros(len(texts), np.int64)
    long = {i: long_fingerprint(t, words, seed) for i, t in enumerate(texts) if len(t) > BLOCK_BYTES}
    for i, text in enumerate(texts):
        if i in long:
            continue
        found = text.lower().split()
        if not found:
            continue
        line = b" ".join(found)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1]
        last = ends[words - 1 :] if len(found) >= words else ends[-1:]
        cuts = zip(starts.tolist(), last.tolist())
        hashes.append(np.array([digest(line[a:b], seed) for a, b in cuts], "<u8"))
        sizes[i] = len(last)
    out = np.zeros(len(texts), "<u8")
    if hashes:
        some = sizes > 0
        flat = np.concatenate(hashes)
        totals = np.zeros((len(hashes), 64), np.int64)
        # A text's shingles may go on in the next block of rows: counts are summed by text.
        owner = np.repeat(np.arange(len(hashes)), sizes[some])
        for at in range(0, len(flat), 1 << 18):
            part, mine = flat[at : at + (1 << 18)], owner[at : at + (1 << 18)]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
            totals[mine[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        packed = np.packbits(2 * totals > sizes[some][:, None], axis=1, bitorder="little")
        out[some] = packed.view("<u8").ravel()
    for i, value in long.items():
        out[i] = value
    return out


def candidate_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints, as parallel arrays of position and key; the top bits of a key name its kind."""
    prints = prints.astype(np.uint64)
    mask = (1 << golay.BITS) - 1
    a = (prints & np.uint64(mask)).astype(np.int64)
    b = ((prints >> np.uint64(golay.BITS)) & np.uint64(mask)).astype(np.int64)
    r = (prints >> np.uint64(2 * golay.BITS)).astype(np.int64)
    near_a, n_a = golay.nearby_indices(a)
    near_b, n_b = golay.nearby_indices(b)
    at, keys = [], []

    def add(kind: int, rows: np.ndarray, values: np.ndarray) -> None:
        at.append(rows)
        keys.append((kind << 48) | values)

    everyone = np.arange(len(prints))
    half, third = REST_BITS // 2, REST_BITS // 3
    for i in range(2):
        part = (r >> (i * half)) & ((1 << half) - 1)
        add(i, everyone, (a << half) | part)
        add(2 + i, everyone, (b << half) | part)
    for i in range(golay.KEYS):
        has_a, has_b = np.flatnonzero(n_a > i), np.flatnonzero(n_b > i)
        add(4, has_a, (r[has_a] << golay.INDEX_BITS) | near_a[has_a, i])
        add(5, has_b, (r[has_b] << golay.INDEX_BITS) | near_b[has_b, i])
        add(6, has_a, (b[has_a] << golay.INDEX_BITS) | near_a[has_a, i])
        add(7, has_b, (a[has_b] << golay.INDEX_BITS) | near_b[has_b, i])
        for j in range(golay.KEYS):
            has = has_a[n_b[has_a] > j]
            both = (near_a[has, i] << golay.INDEX_BITS) | near_b[has, j]
            for k in range(3):
                add(8 + k, has, (both << third) | ((r[has] >> (k * third)) & ((1 << third) - 1)))
    return np.concatenate(at), np.concatenate(keys)


def _print_of(words: int):
    """Function of the text column: its fingerprint. Only texts go to Python, not the rows they stand in."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = [np.zeros(0, "<u8")]
            for at in range(0, len(texts), PRINTED_ROWS):
                out.append(fingerprints([bytes(t) for t in texts.iloc[at : at + PRINTED_ROWS]], words))
            yield pd.Series(np.concatenate(out).view(np.int64))
        give_back()

    return prints


def _keyed(classes: DataFrame) -> DataFrame:
    """(key, print) of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, KEYED_ROWS) for b in batches for i in range(0, b.num_rows, KEYED_ROWS)):
            prints = batch.column("print").to_numpy()
            at, keys = candidate_keys(prints.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[at])], ["key", "print"])

    # A class makes so many keys that the few bytes of a small table are dealt over all tasks first.
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return classes.select("print").repartition(tasks, "print").mapInArrow(run, "key long, print long")


def _near(a: str, b: str, most: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= most


def linked(classes: DataFrame, shelf: Shelf, most: int) -> DataFrame:
    """The components that all pairs of fingerprints at most `most` bits apart make, as (node, root); single ones left out."""
    keyed = _keyed(classes)
    keys = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("print").alias("low"), F.max("print").alias("high"))
    keys = shelf.put(keys.filter("n > 1"), "keys")
    # Most keys have one member, and the two of a key with two are known. Only members of the others are looked up.
    twos = keys.filter(F.col("n") == 2).filter(_near("low", "high", most))
    more = shelf.put(keys.filter(F.col("n") > 2).select("key", "n", F.col("low").alias("pivot")), "more")
    members = sieved(keyed, more, ["key"]).filter("maybe").drop("maybe").join(more.hint("merge"), "key")
    members = shelf.put(members, "members")
    small, hot = members.filter(F.col("n") <= FEW).select("key", "print"), members.filter(F.col("n") > FEW)
    other = small.withColumnRenamed("print", "other")
    paired = small.join(other.hint("merge"), "key").filter((F.col("print") < F.col("other")) & _near("print", "other", most))
    stars = hot.filter((F.col("print") != F.col("pivot")) & _near("print", "pivot", most))
    edges = twos.select(F.col("low").alias("a"), F.col("high").alias("b"))
    edges = edges.unionByName(paired.select(F.col("print").alias("a"), F.col("other").alias("b")))
    edges = edges.unionByName(stars.select(F.col("print").alias("a"), F.col("pivot").alias("b")))
    edges = shelf.put(edges.distinct(), "found")
    roots = shelf.put(components(edges, shelf), "roots")
    if hot.isEmpty():
        return roots
    # What hot keys still hide: links between members that are not yet in one component.
    placed = hot.select("key", "print").join(roots.hint("merge"), F.col("print") == F.col("node"), "left")
    placed = shelf.put(placed.select("key", "print", F.coalesce("root", "print").alias("root")), "placed")
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("root", "n").alias("main"), F.count("*").alias("roots"))
    main = main.filter("roots > 1").drop("roots")
    beside = placed.join(main.hint("merge"), "key").filter("root != main").select(
        "key", F.col("print").alias("other"), F.col("root").alias("other_root")
    )
    crossed = placed.join(shelf.put(beside, "beside").hint("merge"), "key").filter(
        (F.col("root") != F.col("other_root")) & _near("print", "other", most)
    )
    crossed = shelf.put(crossed.select(F.col("print").alias("a"), F.col("other").alias("b")), "crossed")
    return roots if crossed.isEmpty() else components(edges.unionByName(crossed), shelf)


def near_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    most_bits: int = MOST_BITS,
    carry: bool = False,
) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id, kept, and with `carry` the row as `row`.

    component_id is the smallest doc_id that chains of links reach. A null or empty text, or one of white space only, has
    fingerprint zero and is linked like any other. Null ids are larger than all others: a component with null ids only
    has a null component_id. Of each component one row is kept, the one with the smallest id; of rows that repeat
    that id, any one. Without rows the result is empty. Other columns of `docs`, whatever their names, are only in `row`.
    """
    if not 0 <= most_bits <= 4:
        raise ValueError("the keys find fingerprints at most 4 bits apart")
    bounded_batches(docs.sparkSession)
    shelf = Shelf(docs.sparkSession, "simhash")
    text = filled(F.col(f"`{text_col}`")).cast("binary")
    printed = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        _print_of(words)(text).alias("print"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    rest = ["row"] if carry else []
    printed = shelf.put(printed.withColumn("tag", F.monotonically_increasing_id()), "prints")
    classes = shelf.put(
        printed.groupBy("print").agg(
            F.min("doc_id").alias("first"), F.coalesce(F.min_by("tag", "doc_id"), F.min("tag")).alias("tag")
        ),
        "classes",
    )
    roots = linked(classes, shelf, most_bits)
    rooted = classes.join(roots.hint("merge"), F.col("print") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "print")
    )
    rooted = shelf.put(rooted.select("print", "first", "tag", "root"), "rooted")
    groups = rooted.groupBy("root").agg(
        F.min("first").alias("component_id"), F.coalesce(F.min_by("tag", "first"), F.min("tag")).alias("keep")
    )
    named = shelf.put(rooted.select("print", "root").join(groups.hint("merge"), "root").drop("root"), "named")
    return printed.join(named.hint("merge"), "print").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
        (F.col("tag") == F.col("keep")).alias("kept"),
        *rest,
    )
