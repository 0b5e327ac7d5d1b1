"""The sync jobs: full load, incremental refresh, column backfill and the run by sync mode."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.operators.audit import audit_total, load_audit, row_audit
from tidemark.operators.columns import BAD_CELLS, BAD_DATE, STAMP, Field, align, conform, declared_schema, stamp_load
from tidemark.operators.control import (
    PERIODIC_REFRESH,
    RELOAD_ALWAYS,
    RELOAD_ONCE,
    control_modes,
    reset_reload_once,
    resolve_modes,
)
from tidemark.operators.dedupe import drop_exact_duplicates, latest_per_key, require_unique_keys
from tidemark.operators.evolve import WIDEN, TypeRefused, add_columns, missing_fields, type_changes, widen_columns
from tidemark.functions import days_before
from tidemark.operators.ranges import LOOKBACK_DAYS, PAGE_ROWS, chunk_of, recent_window
from tidemark.operators.presence import departed_keys, presence
from tidemark.operators.reconcile import EXTRA, changed_rows, differing_rows
from tidemark.operators.skew import key_join, known
from tidemark.operators.upsert import BROADCAST_KEY_BYTES, fill_columns, key_bytes, keys_fit_broadcast, upsert
from tidemark.plans.config import TableConfig
from tidemark.plans.store import (
    CHUNK,
    Layout,
    Superseded,
    create_target,
    gather_chunks,
    layout_of,
    publish,
    publish_chunks,
    read_chunks,
    read_target,
    touched_chunks,
    update_target,
    version_of,
    with_smallest_folder,
    write_version,
)
from tidemark.sources.sinks import create_by_load, create_schema, drop, drop_schema, fresh_schema, replace_load
from tidemark.workspace import new_folder


#: Hash chunks and batches of the audit where the chunk key is not a number.
HASH_CHUNKS, HASH_BATCHES = 64, 6400
#: Hash buckets of a target whose key has no ranges.
BUCKETS = 256
#: Times that a refresh or backfill starts from the target again because other runs changed it.
MOST_TRIES = 5


class LoadFailed(RuntimeError):
    """A strict load with unreadable cells, or a reload without rows; the target was left as it was."""


@dataclass(frozen=True)
class Result:
    """`uploaded` rows were read well, `rejected` ones are in the rejects table; rows whose date could not be read
    (`bad_dates`) are uploaded without it."""

    table: str
    action: str
    uploaded: int = 0
    new_columns: tuple[str, ...] = ()
    error: str | None = None
    rejected: int = 0
    bad_dates: int = 0
    #: Rows that the target had already, where those are skipped; they are among the uploaded ones.
    unchanged: int = 0
    #: Rows of keys that have left the source, which were removed.
    removed: int = 0


@dataclass(frozen=True)
class Run:
    """One run: where targets and staging tables live, its day and its load time."""

    spark: SparkSession
    schema: str
    root: str
    as_of: dt.date
    load_ts: dt.datetime | Column
    lookback_days: int = LOOKBACK_DAYS
    #: A name of its own: another run of the same schema does not touch its staging tables.
    number: str = field(default_factory=lambda: uuid.uuid4().hex[:12])

    @property
    def staging(self) -> str:
        return f"{self.schema}_staging_{self.number}"

    def moment(self) -> Column:
        return self.load_ts if isinstance(self.load_ts, Column) else F.lit(self.load_ts)

    def target(self, config: TableConfig) -> str:
        return f"{self.schema}.{config.table}"

    def staged(self, config: TableConfig) -> str:
        return f"{self.staging}.{config.table}_staging"

    @property
    def rejects(self) -> str:
        return f"{self.schema}.load_rejects"

    @property
    def audits(self) -> str:
        return f"{self.schema}.load_audit"


def _columns(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


REJECTS = _columns(
    table_name=T.StringType(), load_ts=T.TimestampType(), chunk_id=T.LongType(), reason=T.StringType(), row=T.StringType(),
    load=T.StringType(),
)
AUDITS = _columns(
    table_name=T.StringType(), load_ts=T.TimestampType(), chunk_id=T.LongType(), batches=T.LongType(),
    uploaded=T.LongType(), failed=T.LongType(), succeeded=T.BooleanType(), load=T.StringType(),
)


def open_run(
    spark: SparkSession,
    schema: str,
    as_of: dt.date,
    load_ts: dt.datetime | Column,
    *,
    root: str | None = None,
    lookback_days: int = LOOKBACK_DAYS,
) -> Run:
    """Create the schema where missing and an empty staging schema. Targets live under `root`."""
    run = Run(spark, schema, root or new_folder(spark, schema), as_of, load_ts, lookback_days)
    create_schema(spark, schema, f"{run.root}/tables")
    create_by_load(spark, run.rejects, REJECTS)
    create_by_load(spark, run.audits, AUDITS)
    fresh_schema(spark, run.staging, new_folder(spark, run.staging))
    return run


def close_run(run: Run) -> None:
    drop_schema(run.spark, run.staging)


def target_schema(fields: Sequence[Field]) -> T.StructType:
    """The declared columns and the load stamp."""
    schema = declared_schema(fields)
    return schema if STAMP in {n.lower() for n in schema.names} else schema.add(STAMP, T.TimestampType())


def _named(schema: T.StructType, name: str) -> T.StructField:
    """The field of that name in any letter case."""
    found = [f for f in schema if f.name.lower() == name.lower()]
    if not found:
        raise ValueError(f"there is no column {name}")
    return found[0]


def ensure_target(run: Run, config: TableConfig, fields: Sequence[Field]) -> str:
    """The target's name; an empty target with the declared columns is created where there is none."""
    name, schema, layout = run.target(config), target_schema(fields), None
    if config.layout_range:
        keys = tuple(_named(schema, k).name for k in config.keys)
        ranges = isinstance(_named(schema, keys[0]).dataType, T.IntegralType)
        layout = Layout(keys[0], config.layout_range) if ranges else Layout(keys[0], None, BUCKETS, keys[1:])
    create_target(run.spark, name, schema, f"{run.root}/{config.table}", layout)
    return name


def new_fields(run: Run, config: TableConfig, fields: Sequence[Field]) -> list[Field]:
    """Declared fields the target lacks."""
    stored = read_target(run.spark, run.target(config)).schema
    return [f for f in missing_fields(fields, stored) if f.name.lower() != STAMP]


def read_fields(config: TableConfig, fields: Sequence[Field]) -> list[Field]:
    """The declared fields and the date column, which selects rows even where it is not declared."""
    dated = config.date_col.lower() in {f.name.lower() for f in fields}
    return list(fields) if dated else [*fields, Field(config.date_col, "DATE")]


def _clean(
    run: Run, source: DataFrame, fields: Sequence[Field], needed: Sequence[str] = (), bad_date: str | None = None
) -> DataFrame:
    """Conformed and stamped rows; the `needed` columns must be in the source."""
    lacking = {n.lower() for n in needed} - {c.lower() for c in source.columns}
    if lacking:
        raise ValueError(f"the source lacks the columns {sorted(lacking)}")
    return stamp_load(conform(source, fields, count_bad=True, bad_date=bad_date), run.load_ts)


def _recent(run: Run, config: TableConfig, fields: Sequence[Field], source: DataFrame) -> DataFrame:
    """Clean rows of the recent window. A typed date column is tested in the source, where the filter reaches the scan.

    A row whose date is text that cannot be read may be recent: it stays, without its date, and is marked.
    """
    needed, read = [*config.keys, config.date_col], read_fields(config, fields)
    window = (config.date_col, run.as_of, run.lookback_days)
    kind = next((f.dataType for f in source.schema if f.name.lower() == config.date_col.lower()), None)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return _clean(run, recent_window(source, *window), read, needed, config.date_col)
    rows = _clean(run, source, read, needed, config.date_col)
    return rows.filter((F.col(window[0]) >= days_before(*window[1:])) | F.col(BAD_DATE))


def _stage(run: Run, name: str, rows: DataFrame) -> DataFrame:
    """Write a staging table and read it back: later steps start from stored rows."""
    if not run.spark.catalog.databaseExists(run.staging):
        fresh_schema(run.spark, run.staging, new_folder(run.spark, run.staging))
    drop(run.spark, name)
    rows.write.format("parquet").saveAsTable(name)
    return run.spark.table(name)


def _chunk(df: DataFrame, key: str, size: int, hashed: int) -> Column:
    """Range of a numeric key, hash bucket of another."""
    found = _named(df.schema, key)
    if isinstance(found.dataType, T.NumericType):
        return chunk_of(F.col(f"`{found.name}`"), F.lit(0), size)
    return F.pmod(F.xxhash64(f"`{found.name}`"), F.lit(hashed))


def audit_staged(config: TableConfig, staged: DataFrame, *, by_row: bool = False) -> DataFrame:
    """Load audit of a staging table, one row per key chunk. One bad row fails its batch, or with `by_row` only itself."""
    chunk = _chunk(staged, config.chunk_key, config.batch_range, HASH_CHUNKS).alias("chunk_id")
    good = F.col(BAD_CELLS) == 0
    if by_row:
        return row_audit(staged.select(chunk, BAD_CELLS), "chunk_id", good)
    batch = _chunk(staged, config.chunk_key, PAGE_ROWS, HASH_BATCHES).alias("batch_id")
    return load_audit(staged.select(chunk, batch, BAD_CELLS), "chunk_id", "batch_id", good)


def _report(run: Run, config: TableConfig, rows: DataFrame, batch: str, *, bad_rows: int, strict: bool) -> None:
    """Store the audit of checked rows by chunk, and every bad row, if there are any, with its chunk and reason.

    They replace those of an earlier try of the same load: the same table, load time and batch.
    """
    moment = run.spark.range(1).select(run.moment().cast("string")).first()[0]
    load = f"{config.table} {moment} {batch}"
    told = [F.lit(config.table).alias("table_name"), run.moment().cast("timestamp").alias("load_ts")]
    bad = rows.filter(F.col(BAD_CELLS) > 0).select(
        *told,
        _chunk(rows, config.chunk_key, config.batch_range, HASH_CHUNKS).alias("chunk_id"),
        F.concat(F.col(BAD_CELLS), F.lit(" unreadable or missing cells")).alias("reason"),
        F.to_json(F.struct(*[f"`{c}`" for c in rows.columns if c not in (BAD_CELLS, BAD_DATE)])).alias("row"),
    )
    replace_load(run.spark, bad if bad_rows else None, run.rejects, load)
    audit = audit_staged(config, rows, by_row=not strict)
    replace_load(run.spark, audit.select(*told, "*"), run.audits, load)


def merge_staged(
    run: Run, config: TableConfig, staged: DataFrame, *, only_if_newer: bool = False, strict: bool = True, batch: str = "refresh"
) -> Result:
    """Upsert a staging table into its target, and store its audit under the name of the batch.

    Where another run changes the target meanwhile, the rows are merged again into what it has become.

    Bad rows are stored in the rejects table. If strict, any of them fails the load before the target is changed;
    otherwise the good rows are merged.
    """
    spark, name, keys = run.spark, run.target(config), list(config.keys)
    if BAD_DATE not in staged.columns:
        staged = staged.withColumn(BAD_DATE, F.lit(False))
    facts = staged.agg(
        F.count_if(F.col(BAD_CELLS) == 0).alias("n"),
        F.count_if(F.col(BAD_CELLS) > 0).alias("bad"),
        F.count_if(F.col(BAD_DATE) & (F.col(BAD_CELLS) == 0)).alias("bad_dates"),
        key_bytes(keys).alias("key_bytes"),
    ).first()
    stored = {c.lower() for c in read_target(spark, name).columns}
    if only_if_newer and config.date_col.lower() not in stored:
        raise ValueError(f"{config.table}: to keep newer rows the target must store {config.date_col}; declare it")
    _report(run, config, staged, batch, bad_rows=facts["bad"], strict=strict)
    if facts["bad"] and strict:
        total = audit_total(audit_staged(config, staged)).first()
        raise LoadFailed(f"{config.table}: {facts['bad']} unreadable rows, {total['failed']} in their batches")
    done = Result(config.table, "refresh", facts["n"], rejected=facts["bad"], bad_dates=facts["bad_dates"])
    if not facts["n"]:
        return done
    staged = staged.filter(F.col(BAD_CELLS) == 0) if facts["bad"] else staged
    small = facts["key_bytes"] <= BROADCAST_KEY_BYTES
    staged_rows = staged.drop(BAD_CELLS, BAD_DATE)
    if config.reduce:
        rows = latest_per_key(staged_rows, keys, config.date_col)
    else:
        rows = require_unique_keys(drop_exact_duplicates(staged_rows), keys)
    rows = rows.select(*[c for c in rows.columns if c.lower() in stored])
    newer_by = config.date_col if only_if_newer else None
    options = {"only_if_newer": newer_by, "keys_from": staged, "broadcast_keys": small}
    layout = layout_of(spark, name)
    # With broadcast keys the target's rows stay in the tasks that read them, a partition or few in each.
    gathered = small and not newer_by

    def merge() -> int:
        version, incoming, keys_of, same = version_of(spark, name), rows, staged, 0
        if config.skip_unchanged:
            held = read_target(spark, name) if layout is None else read_chunks(spark, name, touched_chunks(staged, layout))
            differ = changed_rows(rows, held, keys, but=[STAMP], broadcast_keys=small)
            incoming = keys_of = _stage(run, f"{run.staged(config)}_changed", differ)
            differing = incoming.count()
            same = rows.count() - differing
            if not differing:
                return same
        merging = options | {"keys_from": keys_of}
        if layout is None:
            update_target(upsert(read_target(spark, name), incoming, keys, **merging), name, version)
            return same
        chunks = with_smallest_folder(spark, name, touched_chunks(keys_of, layout))
        new = gather_chunks(incoming, layout).drop(CHUNK) if gathered else incoming
        merged = upsert(read_chunks(spark, name, chunks), new, keys, **merging)
        publish_chunks(spark, name, write_version(merged, name, gathered=gathered), chunks, version)
        return same

    unchanged = _until_in_place(merge)
    if config.skip_unchanged:
        drop(spark, f"{run.staged(config)}_changed")
    return replace(done, unchanged=unchanged)


def _until_in_place(step: Callable[[], Any]) -> Any:
    """Run a step that reads and publishes a target again while other runs get in between, `MOST_TRIES` times; what it returns."""
    for left in reversed(range(MOST_TRIES)):
        try:
            return step()
        except Superseded:
            if not left:
                raise


def refresh(run: Run, config: TableConfig, fields: Sequence[Field], source: DataFrame, *, strict: bool = True) -> Result:
    """Widen columns whose declared type has grown, add and backfill newly declared ones, then upsert the rows changed in the
    recent window.

    If strict, as by default, one bad row fails the refresh; otherwise bad rows are rejected and the others merged.
    """
    ensure_target(run, config, fields)
    widen(run, config, fields)
    filled = backfill(run, config, fields, source)
    staged = _stage(run, run.staged(config), _recent(run, config, fields, source))
    done = merge_staged(run, config, staged, strict=strict)
    drop(run.spark, run.staged(config))
    return replace(done, new_columns=filled.new_columns)


def full_load(
    run: Run, config: TableConfig, fields: Sequence[Field], source: DataFrame, *, strict: bool = False
) -> Result:
    """Replace the target by the good rows of the whole source: one write, published only if it has rows.

    Bad rows are stored in the rejects table and counted. If strict, any of them fails the load. It fails too if another run
    changed the target meanwhile: that run may have newer rows than the source had when it was read.
    """
    name = ensure_target(run, config, fields)
    version, wanted = version_of(run.spark, name), target_schema(fields)
    seen = Observation()
    # A retried task may count a row twice, which leaves "none" and "some" right.
    counts = F.count("*").alias("n"), F.count_if(F.col(BAD_CELLS) > 0).alias("bad")
    rows = _clean(run, source, fields)
    good = rows.observe(seen, *counts).filter(F.col(BAD_CELLS) == 0)
    path = write_version(align(good, wanted), name)
    if seen.get["bad"]:
        _report(run, config, rows, "reload", bad_rows=seen.get["bad"], strict=strict)
        if strict:
            raise LoadFailed(f"{config.table}: {seen.get['bad']} rows with unreadable cells")
    rejected = rows.filter(F.col(BAD_CELLS) > 0).count() if seen.get["bad"] else 0
    if not seen.get["n"] or rejected and run.spark.read.schema(wanted).parquet(path).isEmpty():
        raise LoadFailed(f"{config.table}: the source has no rows")
    publish(run.spark, name, path, wanted, version)
    return Result(config.table, "reload", read_target(run.spark, name).count(), rejected=rejected)


def widen(run: Run, config: TableConfig, fields: Sequence[Field]) -> tuple[str, ...]:
    """Write the target with wider types where the declared ones ask for it; the columns that were widened.

    A stored type that holds all declared values stays. A change that could lose values raises `TypeRefused`, and so does one that
    would move rows of a layout between chunks, other than to a longer integer; the target is then left as it was.
    """
    spark, name = run.spark, run.target(config)

    def grow() -> tuple[str, ...]:
        version, stored, layout = version_of(spark, name), read_target(spark, name), layout_of(spark, name)
        changes = type_changes([f for f in fields if f.name.lower() != STAMP], stored.schema)
        wider = widen_columns(stored, changes)
        grown = [c for c in changes if c.action == WIDEN]
        placed = {layout.key, *layout.more_keys} if layout else set()
        moved = [c.name for c in grown if c.name in placed and not isinstance(c.to, T.IntegralType)]
        if moved:
            raise TypeRefused(f"{config.table}: chunks follow from the type of {moved}; reload the table")
        if grown:
            publish(spark, name, write_version(wider, name), wider.schema, version)
        return tuple(c.name for c in grown)

    return _until_in_place(grow)


def backfill(run: Run, config: TableConfig, fields: Sequence[Field], source: DataFrame) -> Result:
    """Add declared columns the target lacks and set them, and only them, from the whole source.

    Columns and values are put in place together. Any unreadable cell of the new columns fails the backfill.
    """
    spark, name, keys = run.spark, run.target(config), list(config.keys)
    new = new_fields(run, config, fields)
    if not new:
        return Result(config.table, "backfill")
    names = [f.name for f in new]
    wanted = {c.lower() for c in (*keys, config.date_col, *names)}
    read = [f for f in read_fields(config, fields) if f.name.lower() in wanted]
    rows = _clean(run, source, read, [*keys, config.date_col]).drop(STAMP)
    rows = rows.filter(known(keys) | (F.col(BAD_CELLS) > 0))
    # Counted before rows are reduced: a bad cell in a row that another supersedes counts here as in a refresh.
    seen = Observation()
    rows = rows.observe(seen, F.count_if(F.col(BAD_CELLS) > 0).alias("bad"))
    rows = latest_per_key(rows, keys, config.date_col) if config.reduce else drop_exact_duplicates(rows)
    staged = _stage(run, run.staged(config), rows)
    if seen.get["bad"]:
        raise LoadFailed(f"{config.table}: {seen.get['bad']} rows with unreadable cells in new columns")
    if not config.reduce:
        require_unique_keys(staged, keys)

    def fill() -> None:
        version, stored = version_of(spark, name), read_target(spark, name)
        lacking = [f for f in new if f.name.lower() not in {c.lower() for c in stored.columns}]
        filled = fill_columns(add_columns(stored, lacking), staged, keys, names)
        publish(spark, name, write_version(filled, name), filled.schema, version)

    _until_in_place(fill)
    drop(spark, run.staged(config))
    return Result(config.table, "backfill", new_columns=tuple(names))


def _remove(run: Run, config: TableConfig, gone: DataFrame, keys: Sequence[str]) -> int:
    """Take the target's rows of some keys away, and no others; how many. With a layout, only their chunks are written."""
    spark, name = run.spark, run.target(config)
    gone = _stage(run, f"{run.staged(config)}_gone", gone)
    layout = layout_of(spark, name)
    # Chunks follow from the first key, or from all of them in hash buckets.
    chunked = layout if layout and {layout.key, *layout.more_keys} <= set(gone.columns) else None
    small = keys_fit_broadcast(gone, keys)

    def take() -> int:
        version = version_of(spark, name)
        chunks = with_smallest_folder(spark, name, touched_chunks(gone, chunked)) if chunked else None
        rows = read_chunks(spark, name, chunks) if chunked else read_target(spark, name)
        lost = key_join(rows, gone, keys, "left_semi", broadcast=small).count()
        if lost:
            kept = key_join(rows, gone, keys, "left_anti", broadcast=small)
            if chunked:
                publish_chunks(spark, name, write_version(kept, name, gathered=small), chunks, version)
            else:
                update_target(kept, name, version)
        return lost

    lost = 0 if gone.isEmpty() else _until_in_place(take)
    drop(spark, f"{run.staged(config)}_gone")
    return lost


def remove_departed(run: Run, config: TableConfig, source: DataFrame, *, most_share: float = 0.1) -> Result:
    """Remove the target's rows whose first key, an integer, no row of the whole source has any more.

    The source needs that column alone, as text or a number. Presence is compared by bitmaps, rows are not joined for it. A
    source without readable keys, or one that would take more than `most_share` of the target's keys away, is taken for broken:
    `LoadFailed`, and the target is left as it was. Rows without a key stay.
    """
    spark, name = run.spark, run.target(config)
    stored = read_target(spark, name)
    key = _named(stored.schema, config.keys[0])
    if not isinstance(key.dataType, T.IntegralType):
        raise ValueError(f"{config.table}: {key.name} is not an integer; departed rows are found by `repair`")
    theirs = conform(source, [Field(key.name, "INTEGER")]).filter(known([key.name]))
    if theirs.isEmpty():
        raise LoadFailed(f"{config.table}: the source has no keys")
    path = new_folder(spark, "departed")
    departed_keys(stored, theirs, key.name).write.parquet(path)
    gone = spark.read.schema(T.StructType([key])).parquet(path)
    leaving = gone.count()
    if leaving:
        held = presence(stored, key.name).agg(F.sum(F.bitmap_count("bits"))).first()[0]
        if leaving > most_share * held:
            raise LoadFailed(f"{config.table}: {leaving} of {held} keys are not in the source")
    return Result(config.table, "remove", removed=_remove(run, config, gone, [key.name]) if leaving else 0)


def compare(
    run: Run, config: TableConfig, fields: Sequence[Field], source: DataFrame, *, buckets: int | None = None
) -> DataFrame:
    """The keys on which target and whole source differ, with `missing`, `extra` or `changed`; stored.

    The source is cleaned and reduced as a load does; unreadable rows are left out. Chunks of `batch_range` keys are compared by
    checksums first; keys that are not one integer are compared in hash buckets, `BUCKETS` unless given.
    """
    rows = _clean(run, source, fields, config.keys).filter(F.col(BAD_CELLS) == 0).drop(BAD_CELLS)
    if config.reduce:
        rows = latest_per_key(rows, list(config.keys), config.date_col)
    rows = _stage(run, f"{run.staged(config)}_source", rows)
    stored = read_target(run.spark, run.target(config))
    one = len(config.keys) == 1 and isinstance(_named(stored.schema, config.keys[0]).dataType, T.IntegralType)
    differ = differing_rows(
        rows, stored, list(config.keys), width=config.batch_range, buckets=buckets or (None if one else BUCKETS), but=[STAMP]
    )
    return _stage(run, f"{run.staged(config)}_differing", differ)


def repair(run: Run, config: TableConfig, fields: Sequence[Field], source: DataFrame) -> Result:
    """Make the target what the whole source is, by writing only what differs: missing and changed rows are merged, extra ones
    removed. Rows without a key are left as they are. A source without readable rows is refused."""
    keys = list(config.keys)
    differ = compare(run, config, fields, source).filter(known(keys))
    rows = run.spark.table(f"{run.staged(config)}_source")
    if rows.isEmpty():
        raise LoadFailed(f"{config.table}: the source has no rows")
    removed = _remove(run, config, differ.filter(F.col("what") == EXTRA).drop("what"), keys)
    wrong = key_join(rows, differ.filter(F.col("what") != EXTRA), keys, "left_semi")
    staged = _stage(run, run.staged(config), wrong.withColumn(BAD_CELLS, F.lit(0)))
    done = merge_staged(run, config, staged, batch="repair")
    for table in ("", "_source", "_differing"):
        drop(run.spark, f"{run.staged(config)}{table}")
    return replace(done, action="repair", removed=removed)


@dataclass(frozen=True)
class Source:
    """What one table's declaration and its current source rows are."""

    fields: Sequence[Field]
    rows: DataFrame


def sync(
    run: Run,
    configs: Mapping[str, TableConfig],
    sources: Mapping[str, Source],
    control: DataFrame,
    position: str,
) -> tuple[list[Result], DataFrame]:
    """Refresh or reload each configured table by its mode; the results and the control table afterwards.

    A failed table is reported in its result and does not stop the others. An unknown mode does nothing.
    """
    tables = [t for t in sources if t in configs]
    modes = resolve_modes(
        run.spark.createDataFrame([(t,) for t in tables], "Table_Name string"), control_modes(control, position)
    )
    chosen = {r["Table_Name"]: r["Sync_Mode"] for r in modes.collect()}
    steps = {PERIODIC_REFRESH: refresh, RELOAD_ONCE: full_load, RELOAD_ALWAYS: full_load}
    results, reloaded = [], []
    for table in tables:
        step = steps.get(chosen[table])
        if step is None:
            results.append(Result(table, "none", error=f"unknown sync mode {chosen[table]!r}"))
            continue
        try:
            results.append(step(run, configs[table], sources[table].fields, sources[table].rows))
        except Exception as failure:  # whatever is wrong with one table, the others are synced and it is reported
            results.append(Result(table, "none", error=f"{type(failure).__name__}: {failure}"))
            continue
        if chosen[table] == RELOAD_ONCE:
            reloaded.append(table)
    return results, reset_reload_once(control, reloaded)


def sync_by_table(
    run: Run, configs: Mapping[str, TableConfig], sources: Mapping[str, Source], control_table: str, position: str
) -> list[Result]:
    """`sync` with a stored control table, which is rewritten if a one-time reload was done."""
    control = read_target(run.spark, control_table)
    results, after = sync(run, configs, sources, control, position)
    if any(r.action == "reload" for r in results):
        update_target(after, control_table)
    return results
