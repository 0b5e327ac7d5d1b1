"""Incremental refresh as a Structured Streaming job over landed pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.columns import Field, conform, landed_schema, stamp_load
from tidemark.plans.config import TableConfig
from tidemark.plans.jobs import Run, ensure_target, merge_staged, read_fields
from tidemark.plans.store import read_target
from tidemark.sources.pages import stream_pages
from tidemark.sources.sinks import drop


def stream_refresh(
    run: Run,
    config: TableConfig,
    fields: Sequence[Field],
    landed: str,
    checkpoint: str,
    *,
    files_per_batch: int | None = None,
    only_if_newer: bool = True,
    strict: bool = False,
) -> StreamingQuery:
    """Upsert every landed file not seen yet, then stop.

    Each micro-batch is staged, audited and merged like a refresh. The merge is idempotent by key and audit and rejects are
    stored by batch, so a batch that is run again after a failure changes nothing. With `only_if_newer` the order in which
    files arrive does not matter either: an older row never replaces a newer one; the target must store the date.
    Bad rows are stored as rejects and the stream goes on; if strict, the first of them stops it.
    """
    name = ensure_target(run, config, fields)
    if only_if_newer and config.date_col.lower() not in {c.lower() for c in read_target(run.spark, name).columns}:
        raise ValueError(f"{config.table}: to keep newer rows the target must store {config.date_col}; declare it")

    def merge(batch: DataFrame, number: int) -> None:
        name = f"{run.staged(config)}_{number}"
        drop(run.spark, name)
        batch.write.format("parquet").saveAsTable(name)
        merge_staged(run, config, run.spark.table(name), only_if_newer=only_if_newer, strict=strict, batch=f"{checkpoint} {number}")
        drop(run.spark, name)

    read = read_fields(config, fields)
    rows = stream_pages(run.spark, landed, landed_schema(read), files_per_batch)
    cleaned = stamp_load(conform(rows, read, count_bad=True, bad_date=config.date_col), run.load_ts)
    return (
        cleaned.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
