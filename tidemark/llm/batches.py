"""Arrow batches of text columns, cut into slices of bounded size."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes of an Arrow batch that Spark sends to Python, where the session does not say otherwise.
ARROW_BYTES = "4m"


def bounded_batches(spark: SparkSession) -> None:
    """Have batches to Python end by size, not only by rows: 10,000 long texts in one may be more than a task can hold.

    The session's own setting stays where there is one.
    """
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, ARROW_BYTES)


_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def white_blocks(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The text in blocks of about `size`, cut where white space begins: no word is cut, and none is lost."""
    at = 0
    while len(text) - at > size:
        border = _SPACE.search(text, at + size)
        if border is None:
            break
        yield text[at : border.start()]
        at = border.start()
    yield text[at:] if at else text


def give_back() -> None:
    """Return freed memory to the system. Spark uses a Python worker again for other tasks, whose memory counts on top."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have at most `most_bytes`, or one row that has more. Small batches are not joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def gathered(parts: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    """Lists of slices that have about `most_bytes` of text together."""
    held, size = [], 0
    for part in slices(parts, column, most_bytes):
        held.append(part)
        size += part.column(column).nbytes
        if size >= most_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held
