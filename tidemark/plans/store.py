"""Stored targets: views over parquet versions that are written aside and then put in place by one statement.

Parquet tables of the session catalog know no MERGE and cannot be overwritten while they are read. A new version is
written to a folder of its own; then the target's view is replaced, schema, folders and properties at once. Readers see
the old version until then, and a job that dies before that point has changed nothing and can be run again.

A target with a layout keeps its rows in chunks, ranges of an integer key or hash buckets of any other. A refresh writes
only the chunks it touches, to a new folder, and the view takes each chunk from the folder that the target's manifest, a
small table, names for it. So its cost follows the changed chunks and not the table, and putting them in place is one
statement for any number of them. Where there are many folders, a refresh also takes the chunks of the smallest along.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.columns import align
from tidemark.operators.ranges import chunk_of

CHUNK = "key_chunk"
#: The chunk of rows without a key.
NO_CHUNK = -(1 << 62)
#: A refresh of a target with so many folders frees the smallest of them.
MOST_FOLDERS = 16
#: So many touched chunks are listed in the plan, where they prune folders before the scan; more are joined.
LISTED_CHUNKS = 1000

_ROOT = "tidemark.root"
_KEYS = "tidemark.layout.keys"
_RANGE = "tidemark.layout.range"
_BUCKETS = "tidemark.layout.buckets"
_FOLDERS = "tidemark.folders"
_MANIFEST = "tidemark.manifest"
_VERSION = "tidemark.version"


class Superseded(RuntimeError):
    """Another run put a version in place after this one read the target; nothing was changed."""


@dataclass(frozen=True)
class Layout:
    """Chunks of `range` values of an integer key, or, without a range, `buckets` hash buckets of all keys."""

    key: str
    range: int | None = None
    buckets: int | None = None
    more_keys: tuple[str, ...] = ()

    def chunk(self) -> Column:
        key = F.col(f"`{self.key}`")
        if self.range:
            return F.coalesce(chunk_of(key, F.lit(0), self.range), F.lit(NO_CHUNK)).cast("bigint")
        keys = [key, *(F.col(f"`{k}`") for k in self.more_keys)]
        return F.pmod(F.xxhash64(*[k.cast("string") for k in keys]), F.lit(self.buckets)).cast("bigint")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _layout(properties: dict[str, str]) -> Layout | None:
    if _KEYS not in properties:
        return None
    key, *more = properties[_KEYS].split("\t")
    number = lambda p: int(properties[p]) if properties.get(p) else None
    return Layout(key, number(_RANGE), number(_BUCKETS), tuple(more))


def _folders(properties: dict[str, str]) -> list[str]:
    return [f for f in properties.get(_FOLDERS, "").split("\t") if f]


def version_of(spark: SparkSession, name: str) -> str:
    """Names what the target now is. Read before the target, it lets `publish` refuse to undo what others did meanwhile."""
    return _properties(spark, name).get(_VERSION, "")


def _unchanged(spark: SparkSession, name: str, based_on: str | None) -> None:
    if based_on is not None and version_of(spark, name) != based_on:
        raise Superseded(f"{name} was changed by another run")


def layout_of(spark: SparkSession, name: str) -> Layout | None:
    return _layout(_properties(spark, name))


def create_target(
    spark: SparkSession, name: str, schema: T.StructType, root: str, layout: Layout | None = None
) -> None:
    """An empty target under the folder `root`; an existing one is left alone."""
    if not spark.catalog.tableExists(name):
        _point(spark, name, schema, root, layout, [])


def _point(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    root: str,
    layout: Layout | None,
    folders: list[str],
    manifest: str = "",
) -> None:
    """Replace the target's view, in one statement. Without a manifest there is at most one folder."""
    fields = [f for f in schema if f.name != CHUNK]
    columns = ", ".join(f"d.`{f.name}`" for f in fields)
    chunk = f", CAST(d.`{CHUNK}` AS BIGINT) AS `{CHUNK}`" if layout else ""
    if not folders:
        nulls = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields]
        nulls += [f"CAST(NULL AS BIGINT) AS `{CHUNK}`"] if layout else []
        query = f"SELECT {', '.join(nulls)} FROM VALUES (0) WHERE false"
    elif not manifest:
        query = f"SELECT {columns}{chunk} FROM parquet.`{folders[0]}` d"
    else:
        query = " UNION ALL ".join(
            f"SELECT {columns}{chunk} FROM parquet.`{f}` d LEFT SEMI JOIN parquet.`{manifest}` m "
            f"ON d.`{CHUNK}` = m.chunk AND m.folder = '{f}'"
            for f in folders
        )
    properties = {_ROOT: root, _FOLDERS: "\t".join(folders), _MANIFEST: manifest, _VERSION: uuid.uuid4().hex}
    if layout:
        properties[_KEYS] = "\t".join([layout.key, *layout.more_keys])
        properties |= {_RANGE: str(layout.range or ""), _BUCKETS: str(layout.buckets or "")}
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({pairs}) AS {query}")


def read_target(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(CHUNK)


def gather_chunks(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows of a chunk together: AQE joins small chunks in a task and splits a large one over several."""
    return df.withColumn(CHUNK, layout.chunk()).hint("rebalance", CHUNK)


def write_version(df: DataFrame, name: str, *, gathered: bool = False) -> str:
    """Write `df` as a version of the target without showing it to readers; the folder written.

    With a layout, rows are gathered by chunk, so that a chunk has few files and a hot one does
    not meet in one task. `gathered` says that each task of `df` already holds few chunks.
    """
    spark = df.sparkSession
    properties = _properties(spark, name)
    path, layout = f"{properties[_ROOT]}/{uuid.uuid4().hex}", _layout(properties)
    if layout is None:
        df.write.parquet(path)
    else:
        placed = df.withColumn(CHUNK, layout.chunk()) if gathered else gather_chunks(df, layout)
        placed.write.partitionBy(CHUNK).parquet(path)
    return path


def _filesystem(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _holds_rows(spark: SparkSession, path: str) -> bool:
    """Whether a version in chunks has any: without rows it has no file, and so no schema."""
    files, place = _filesystem(spark, path)
    return any(f.getPath().getName().startswith(f"{CHUNK}=") for f in files.listStatus(place))


def publish(
    spark: SparkSession, name: str, path: str, schema: T.StructType | None = None, based_on: str | None = None
) -> None:
    """Make the version at `path` the whole target, with its schema; `Superseded` if the target is no longer `based_on`."""
    properties, schema = _properties(spark, name), schema or read_target(spark, name).schema
    layout = _layout(properties)
    folders = [path] if layout is None or _holds_rows(spark, path) else []
    _unchanged(spark, name, based_on)
    _point(spark, name, schema, properties[_ROOT], layout, folders)


def publish_chunks(spark: SparkSession, name: str, path: str, touched: DataFrame, based_on: str | None = None) -> None:
    """Put the chunks of `touched` from `path` in place; the others stay. `Superseded` if the target is no longer `based_on`,
    or changes while the manifest is written."""
    properties, schema = _properties(spark, name), read_target(spark, name).schema
    based_on = properties.get(_VERSION, "") if based_on is None else based_on
    layout, root, old = _layout(properties), properties[_ROOT], _folders(properties)

    def held(folder: str) -> DataFrame:
        chunks = spark.read.parquet(folder).select(F.col(CHUNK).cast("bigint").alias("chunk")).distinct()
        return chunks.withColumn("folder", F.lit(folder))

    if properties.get(_MANIFEST):
        before = spark.read.parquet(properties[_MANIFEST])
    else:
        before = held(old[0]) if old else spark.createDataFrame([], "chunk bigint, folder string")
    after = before.join(touched.select(F.col(CHUNK).alias("chunk")), "chunk", "left_anti")
    if _holds_rows(spark, path):
        after = after.unionByName(held(path))
    manifest = f"{root}/manifest-{uuid.uuid4().hex}"
    after.coalesce(1).write.parquet(manifest)
    folders = sorted(r["folder"] for r in spark.read.parquet(manifest).select("folder").distinct().collect())
    _unchanged(spark, name, based_on)
    _point(spark, name, schema, root, layout, folders, manifest)


def with_smallest_folder(spark: SparkSession, name: str, touched: DataFrame) -> DataFrame:
    """The touched chunks, and, where the target has `MOST_FOLDERS` folders, those of the folder that holds the fewest.

    A refresh that writes them all frees that folder, so their number stays and the whole target is never written for it.
    """
    properties = _properties(spark, name)
    if len(_folders(properties)) < MOST_FOLDERS:
        return touched
    held = spark.read.parquet(properties[_MANIFEST])
    fewest = held.groupBy("folder").count().orderBy("count", "folder").first()["folder"]
    return touched.union(held.filter(F.col("folder") == fewest).select("chunk")).distinct()


def replace_target(df: DataFrame, name: str) -> None:
    """The target becomes exactly `df`, rows and schema. `df` may read the target."""
    path = write_version(df, name)
    publish(df.sparkSession, name, path, df.schema)


def update_target(df: DataFrame, name: str, based_on: str | None = None) -> None:
    """The target's rows become those of `df`, in the target's schema; `Superseded` if it is no longer `based_on`."""
    spark = df.sparkSession
    schema = read_target(spark, name).schema
    publish(spark, name, write_version(align(df, schema), name), schema, based_on)


def touched_chunks(df: DataFrame, layout: Layout) -> DataFrame:
    """The chunks that the rows of `df` belong to, each once."""
    return df.select(layout.chunk().alias(CHUNK)).distinct()


def read_chunks(spark: SparkSession, name: str, touched: DataFrame) -> DataFrame:
    """The target's rows in the chunks of `touched`. A short list prunes files at planning time, a long one is joined."""
    some = [r[CHUNK] for r in touched.limit(LISTED_CHUNKS + 1).collect()]
    if len(some) <= LISTED_CHUNKS:
        return spark.table(name).filter(F.col(CHUNK).isin(some)).drop(CHUNK)
    return spark.table(name).join(touched, CHUNK, "left_semi").drop(CHUNK)


def remove_old_versions(spark: SparkSession, name: str, older_than: dt.datetime) -> list[str]:
    """Delete folders under the target's root that it does not read and that were last written before `older_than`.

    A moment well before the oldest running job or query keeps what those still write or read; the names removed.
    """
    properties = _properties(spark, name)
    used = {f.rstrip("/").rsplit("/", 1)[-1] for f in [*_folders(properties), properties.get(_MANIFEST, "")]}
    files, place = _filesystem(spark, properties[_ROOT])
    limit = int(older_than.timestamp() * 1000)
    if not files.exists(place):
        return []
    old = [f for f in files.listStatus(place) if f.isDirectory() and f.getModificationTime() < limit]
    gone = [f.getPath() for f in old if f.getPath().getName() not in used]
    for path in gone:
        files.delete(path, True)
    return sorted(p.getName() for p in gone)
