"""Filter interaction audit by an incremental stream with retractions.

All files of a table are read as available-now micro-batches. Python sees each text once and leaves the mask of the
filters it fails and a digest. What a filter on copies says of a text depends on rows that may come later: the state kept for
each digest holds the smallest id seen so far and the counts of its rows, and when a smaller id arrives, those rows are
taken from their counter and added to the one with the copies' bit. Copies that one task reads are counted before the shuffle, so
a text that a third of all rows share sends a few rows for each batch of a task. A micro-batch's counter changes are one
small table, written under its number: a batch that runs again after a failure replaces its own. What any order of the
filters does follows from the sums of the counters alone.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.llm.batches import bounded_batches, text_bytes, white_blocks
from tidemark.llm.text import Shelf, filled
from tidemark.operators.skew import spread

#: The filters, each a bit of the mask in this order; the last one is that on copies.
FILTERS = "ABCDE"
COPY = 1 << 4
FILES_PER_BATCH = 4
#: Buckets of digests, at least, and rows of the table for each where there are more.
BUCKETS, BUCKET_ROWS = 1024, 1000
#: Stands for a null id: it is larger than all others.
BEYOND = 1 << 63

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


@dataclass(frozen=True)
class Limits:
    """Failing are texts of fewer words, with fewer different words in a hundred, more capitals in a hundred characters,
    and with any of the signs."""

    least_words: int = 200
    different: int = 50
    capitals: int = 3
    signs: bytes = rb"[#$%&*|]"


def counted_words(text: bytes, block: int = 1 << 20) -> tuple[int, int]:
    """Number of words and of different words; a long text is split in blocks, and only its different words are held."""
    n, different = 0, set()
    for part in white_blocks(text, block):
        words = part.split()
        n += len(words)
        different.update(words)
    return n, len(different)


def mask_of(text: bytes, limits: Limits) -> int:
    """The bits of the filters that the text fails by itself."""
    n, different = counted_words(text)
    points = int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (n < limits.least_words)
        | (100 * different < limits.different * n) << 1
        | (100 * capitals > limits.capitals * points) << 2
        | (re.search(limits.signs, text) is not None) << 3
    )


class Copies:
    """Rows of one text: the smallest id, how many rows of each kind have it, and how many have another."""

    def __init__(self):
        self.low, self.first, self.others = None, {}, {}

    def add(self, row_id: int, kind: tuple, first: int = 1, others: int = 0) -> None:
        """`first` rows of this kind and id, and `others` that are known to have a larger one."""
        if self.low is None or row_id < self.low:
            for k, n in self.first.items():
                self.others[k] = self.others.get(k, 0) + n
            self.low, self.first = row_id, {kind: first}
        else:
            into = self.first if row_id == self.low else self.others
            into[kind] = into.get(kind, 0) + first
        if others:
            self.others[kind] = self.others.get(kind, 0) + others


def _masked(limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array([mask_of(t, limits) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                ["doc_id", "part", "mask", "digest"],
            )

    return run


_COMBINED = "digest binary, mask int, low long, part string, good boolean, toxic boolean, n_first long, n_others long"


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one text in a batch, as one row for each kind of them."""
    names = ["digest", "mask", "doc_id", "part", "good", "toxic"]
    for batch in batches:
        groups: dict[bytes, tuple[int, Copies]] = {}
        for digest, mask, row_id, *kind in zip(*(batch.column(n).to_pylist() for n in names)):
            group = groups.get(digest)
            if group is None:
                group = groups[digest] = (mask, Copies())
            group[1].add(BEYOND if row_id is None else row_id, tuple(kind))
        rows = [
            (digest, mask, None if c.low == BEYOND else c.low, *kind, c.first.get(kind, 0), c.others.get(kind, 0))
            for digest, (mask, c) in groups.items()
            for kind in c.first | c.others
        ]
        kinds = [pa.binary(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
        columns = zip(*rows) if rows else [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], [f.split()[0] for f in _COMBINED.split(", ")])


def changes(before: tuple[int, dict] | None, now: Copies, mask: int) -> tuple[tuple[int, dict], list[tuple]]:
    """The new state of a text, and what its counters change by: (mask, kind, n), where n may be negative."""
    out = [(mask | COPY, kind, n) for kind, n in now.others.items() if n]
    if before is None or now.low < before[0]:
        for kind, n in (before[1] if before else {}).items():
            out += [(mask, kind, -n), (mask | COPY, kind, n)]
        return (now.low, now.first), out + [(mask, kind, n) for kind, n in now.first.items() if n]
    if now.low > before[0]:
        return before, out + [(mask | COPY, kind, n) for kind, n in now.first.items() if n]
    first = dict(before[1])
    for kind, n in now.first.items():
        first[kind] = first.get(kind, 0) + n
    return (now.low, first), out + [(mask, kind, n) for kind, n in now.first.items() if n]


_CHANGES = "part string, mask int, good boolean, toxic boolean, n long"


def _track(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The texts of one bucket of digests: what arrived for each, and what is known of it."""
    arrived: dict[str, tuple[int, Copies]] = {}
    for frame in frames:
        for row in zip(*(frame[c].tolist() for c in ("digest", "mask", "low", "part", "good", "toxic", "n_first", "n_others"))):
            digest, mask, low, *kind, first, others = row
            _, now = arrived.setdefault(digest, (mask, Copies()))
            now.add(int(low), tuple(kind), first, others)
    held = json.loads(state.get[0]) if state.exists else {}
    sums: dict[tuple, int] = {}
    for digest, (mask, now) in arrived.items():
        before = None
        if digest in held:
            low, kinds = held[digest]
            before = low, {(p, g, t): n for p, g, t, n in kinds}
        (low, kinds), out = changes(before, now, mask)
        held[digest] = low, [[*kind, n] for kind, n in kinds.items() if n]
        for m, kind, n in out:
            sums[m, kind] = sums.get((m, kind), 0) + n
    state.update((json.dumps(held),))
    told = [(part, m, good, toxic, n) for (m, (part, good, toxic)), n in sums.items()]
    yield pd.DataFrame(told, columns=["part", "mask", "good", "toxic", "n"])


def counters(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    *,
    limits: Limits = Limits(),
    files_per_batch: int = FILES_PER_BATCH,
    buckets: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """(part, mask, good, toxic, n): rows of the table of Parquet files at `path` by the filters they fail.

    The stream's checkpoint, with the state, and the counter changes are in the shared folder. The state of a text is its
    digest, smallest id and the counts of its rows, about 100 bytes. Texts share a state row by buckets of their digest,
    about `BUCKET_ROWS` of the table's rows in each, since Spark calls Python once for each state row and micro-batch. A
    bucket that receives rows is written anew: have few micro-batches. Where all state does not fit in the
    executors' memory, set the RocksDB state store in the session.
    """
    bounded_batches(spark)
    shelf = Shelf(spark, "filter-audit")
    folder = f"{shelf.root}/changes"
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    told = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col("quality").alias("good"), F.col("toxic"))
    told = shelf.put(told.filter("doc_id is not null").groupBy("doc_id").agg(flag("good"), flag("toxic")), "labels")
    files = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_batch)
    # As a pattern that only this path fits, a single file can be a stream's source too, not only a folder.
    rows = files.parquet(f"{path[:-1]}[{path[-1]}]").select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        filled(F.col(f"`{text_col}`")).cast("binary").alias("text"),
    )
    masked = rows.mapInArrow(_masked(limits), "doc_id long, part string, mask int, digest binary")
    known = spread(masked, ["doc_id"]).join(spread(told, ["doc_id"]), ["doc_id", "_spread"], "left").select(
        "digest", "mask", "doc_id", "part", *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic"))
    )
    # To pandas ids go as text: a column of integers with a null would become floats.
    combined = known.mapInArrow(_combined, _COMBINED).withColumns({
        "low": F.coalesce(F.col("low").cast("string"), F.lit(str(BEYOND))),
        "bucket": F.pmod(F.xxhash64("digest"), F.lit(buckets or max(BUCKETS, spark.read.parquet(path).count() // BUCKET_ROWS))),
        "digest": F.hex("digest"),
    })
    tracked = combined.groupBy("bucket").applyInPandasWithState(_track, _CHANGES, "texts string", "update", GroupStateTimeout.NoTimeout)

    def count(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        sums.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    stream = tracked.writeStream.outputMode("update").foreachBatch(count).trigger(availableNow=True)
    stream.option("checkpointLocation", f"{shelf.root}/checkpoint").start().awaitTermination()
    empty = spark.createDataFrame([], f"{_CHANGES}, batch int")
    empty.write.mode("append").parquet(f"{folder}/batch=-1")
    sums = spark.read.schema(_CHANGES).parquet(folder)
    return sums.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def steps(spark: SparkSession) -> DataFrame:
    """Each step of each order: (filter_order, step, bit, before), `before` being the mask of the filters before it. 600 rows."""
    rows = []
    for order in map("".join, permutations(FILTERS)):
        bits = [1 << FILTERS.index(f) for f in order]
        rows += [(order, i + 1, bit, sum(bits[:i])) for i, bit in enumerate(bits)]
    return spark.createDataFrame(rows, "filter_order string, step int, bit int, before int")


def interactions(counts: DataFrame) -> DataFrame:
    """For each part, order and step what its filter does: the columns of `audit_filters`.

    A step depends only on its filter and the set of those before it, 80 cases, which are summed once for all orders.
    """
    spark, all_ = counts.sparkSession, (1 << len(FILTERS)) - 1
    cases = [(1 << i, b) for i in range(len(FILTERS)) for b in range(all_ + 1) if not b >> i & 1]
    each = counts.select("*", F.inline(F.array(*[F.struct(F.lit(x).alias("bit"), F.lit(b).alias("before")) for x, b in cases])))
    fails, gone = F.expr("mask & bit") != 0, F.expr("mask & before") != 0
    here = ~gone & fails
    total = lambda which: F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0)).cast("long")
    summed = each.groupBy("part", "bit", "before").agg(
        total(~gone & ~fails).alias("kept"),
        total(here).alias("removed"),
        total(gone & fails).alias("redundant"),
        total(F.expr("mask = bit")).alias("unique_fails"),
        total(here & F.col("good")).alias("good_lost"),
        total(here & F.col("toxic")).alias("toxic_lost"),
    )
    # How many orders have this set of filters before this one.
    before = F.bit_count("before").cast("int")
    ways = F.element_at(F.array(*[F.lit(math.factorial(k) * math.factorial(4 - k)) for k in range(5)]), before + 1)
    summed = summed.withColumn("shapley", F.sum(F.col("removed") * ways).over(Window.partitionBy("part", "bit")).cast("long"))
    return summed.join(F.broadcast(steps(spark)), ["bit", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit_filters(spark: SparkSession, path: str, labels: DataFrame, **options) -> DataFrame:
    """How filters A to E act in each of their 120 orders, for each part (value of `lang`) of the documents at `path`.

    One row per part, filter_order and step, with counts of the part's documents: kept after the step, removed in it,
    redundant (failing its filter, removed before), unique_fails (failing it only), good_lost and toxic_lost (removed in
    it, labelled so), and shapley (what its filter removes, summed over all orders).

    A null text counts as empty, a null part is the empty string. E fails a row whose text a smaller id has: a null id is larger
    than all others, and rows that repeat the smallest id all pass. Labels that are null, repeated or of no document are
    no reason to fail: a document is good or toxic if any of its labels says 1. Other columns, whatever their names,
    are not looked at. Without rows the result is empty.
    """
    return interactions(counters(spark, path, labels, **options))
