"""Upserts: matched keys take the source row, other source rows are inserted, other target rows stay.

Null keys never match: such target rows stay and such source rows are inserted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.columns import align
from tidemark.operators.dedupe import latest_per_key, require_unique_keys
from tidemark.operators.skew import key_join, known, spread

# A broadcast hash table of this many key bytes stays far below any executor's memory.
BROADCAST_KEY_BYTES = 64 * 1024 * 1024


def key_bytes(keys: Sequence[str]) -> Column:
    """Aggregate: about how many bytes the keys of all rows take in a hash table."""
    each = [F.coalesce(F.octet_length(F.col(f"`{k}`").cast("string")), F.lit(0)) + 16 for k in keys]
    return F.coalesce(F.sum(reduce(lambda a, b: a + b, each).cast("bigint")), F.lit(0))


def keys_fit_broadcast(source: DataFrame, keys: Sequence[str], limit: int = BROADCAST_KEY_BYTES) -> bool:
    """Whether the keys of `source` are small enough to broadcast. Runs one aggregate; give it stored rows."""
    return source.agg(key_bytes(keys).alias("bytes")).first()["bytes"] <= limit


def _check(target: DataFrame, source: DataFrame) -> None:
    new = sorted(set(map(str.lower, source.columns)) - set(map(str.lower, target.columns)))
    if new:
        raise ValueError(f"the target lacks the columns {new}; add them first")


def _join(target: DataFrame, rows: DataFrame, keys: Sequence[str], how: str, *payload: Column) -> DataFrame:
    """Each target row beside `payload` of the source row with its key."""
    theirs = spread(rows, keys).select(
        *[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_spread").alias("_at"), *payload
    )
    ours = spread(target, keys)
    same = [ours[k] == theirs[f"_key{i}"] for i, k in enumerate(keys)]
    return ours.join(theirs, [*same, ours["_spread"] == theirs["_at"]], how)


def _choose(target: DataFrame, incoming: Mapping[str, Column], take: Column) -> list[Column]:
    """The target's columns, with the incoming value where there is one and `take` holds."""
    return [
        F.when(take, incoming[f.name.lower()].cast(f.dataType)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
        if f.name.lower() in incoming
        else F.col(f"`{f.name}`")
        for f in target.schema
    ]


def _replace(
    target: DataFrame, rows: DataFrame, keys_from: DataFrame, keys: Sequence[str], broadcast_keys: bool
) -> DataFrame:
    """Target rows whose key the source lacks, and all source rows."""
    kept = key_join(target, keys_from, keys, "left_anti", broadcast=broadcast_keys)
    return kept.unionByName(align(rows, target.schema))


def _merge(target: DataFrame, rows: DataFrame, keys: Sequence[str], newer_by: str | None, how: str) -> DataFrame:
    """Target rows with the values of their source row; with a full join also the source rows without one."""
    joined = _join(target, rows, keys, how, F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"))
    incoming = {c.lower(): F.col(f"_row.`{c}`") for c in rows.columns}
    take = F.col("_row").isNotNull()
    if newer_by:
        ours, new = F.col(f"`{newer_by}`"), incoming[newer_by.lower()]
        take = take & (ours.isNull() | (new >= ours))
    return joined.select(*_choose(target, incoming, take))


def _merge_and_add(
    target: DataFrame,
    rows: DataFrame,
    keys_from: DataFrame,
    keys: Sequence[str],
    newer_by: str | None,
    broadcast_keys: bool,
    unique: bool,
) -> DataFrame:
    """The same as a full join in parts. With broadcast keys only the target rows that match are joined, all
    others pass through; without, the join of the whole target can split a hot target key."""
    if broadcast_keys:
        kept = key_join(target, keys_from, keys, "left_anti", broadcast=True)
        target = key_join(target, keys_from, keys, "left_semi", broadcast=True)
        if unique:
            return kept.unionByName(_merge(target, rows, keys, newer_by, "full"))
        merged = _merge_and_add(target, rows, keys_from, keys, newer_by, False, False)
        return kept.unionByName(merged)
    updated = _merge(target, rows, keys, newer_by, "left")
    matched = key_join(target.select(*keys), keys_from, keys, "left_semi", broadcast=broadcast_keys)
    added = key_join(rows, matched, keys, "left_anti")
    return updated.unionByName(align(added, target.schema))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    keys_from: DataFrame | None = None,
    only_if_newer: str | None = None,
    target_keys_unique: bool = True,
    broadcast_keys: bool = False,
) -> DataFrame:
    """Upsert a source that has at most one row per key.

    A source with all columns of a target with unique keys replaces whole rows: target rows whose key is
    in the source go (one anti join on the keys), all source rows come in. Otherwise the source row is
    joined to each target row, so that columns only the target has keep their values. `only_if_newer`
    names a date column: an older source row then leaves its target row alone. Where target keys may
    repeat, every target row of a key is updated.
    `keys_from` is a cheaper frame with the same keys, such as the stored rows that `source` was reduced from.
    `broadcast_keys` is for callers that have checked the size (`keys_fit_broadcast`); the target is then
    not shuffled at all.
    """
    _check(target, source)
    keys_from = source if keys_from is None else keys_from
    covers = set(map(str.lower, target.columns)) <= set(map(str.lower, source.columns))
    if covers and target_keys_unique and not only_if_newer:
        return _replace(target, source, keys_from, keys, broadcast_keys)
    if target_keys_unique and not broadcast_keys:
        return _merge(target, source, keys, only_if_newer, "full")
    return _merge_and_add(target, source, keys_from, keys, only_if_newer, broadcast_keys, target_keys_unique)


def upsert_latest(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    date_col: str,
    ties: Sequence[str] | None = None,
    *,
    only_if_newer: bool = False,
    target_keys_unique: bool = True,
    broadcast_keys: bool = False,
) -> DataFrame:
    """Reduce the source to the newest row per key, then upsert it."""
    return upsert(
        target,
        latest_per_key(source, keys, date_col, ties),
        keys,
        keys_from=source,
        only_if_newer=date_col if only_if_newer else None,
        target_keys_unique=target_keys_unique,
        broadcast_keys=broadcast_keys,
    )


def upsert_unique(target: DataFrame, source: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Upsert on a (composite) key without reducing the source; raises if a source key is repeated."""
    return upsert(target, require_unique_keys(source, keys), keys, **options)


def fill_columns(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    date_col: str | None = None,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Set only `columns` of the target, from the newest source row per key; other columns stay as they are.

    Unmatched target rows keep what they have. Nothing is inserted.
    """
    wanted = list(dict.fromkeys([*keys, *([date_col] if date_col else []), *(ties or []), *columns]))
    rows = source.select(*wanted).filter(known(keys))
    if date_col:
        rows = latest_per_key(rows, keys, date_col, ties)
    joined = _join(
        target, rows, keys, "left", *[F.col(f"`{c}`").alias(f"_new{i}") for i, c in enumerate(columns)], F.lit(True).alias("_hit")
    )
    incoming = {c.lower(): F.col(f"_new{i}") for i, c in enumerate(columns)}
    return joined.select(*_choose(target, incoming, F.col("_hit")))
