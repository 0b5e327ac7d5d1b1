"""Catalog writes: create, append, truncate, clone, and the staging schema. `plans.store` replaces tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.columns import Field, align, declared_schema


def create_table(spark: SparkSession, name: str, schema: T.StructType | Sequence[Field], path: str | None = None) -> None:
    """An empty table with the declared columns; an existing table is left alone."""
    if spark.catalog.tableExists(name):
        return
    struct = schema if isinstance(schema, T.StructType) else declared_schema(schema)
    spark.catalog.createTable(name, path=path, source="parquet", schema=struct)


def clone_table(spark: SparkSession, name: str, like: str, path: str | None = None) -> None:
    """An empty table with the schema of another."""
    create_table(spark, name, spark.table(like).schema, path)


def append(df: DataFrame, name: str) -> None:
    """Add rows by column name, without deduplication; columns `df` lacks become null."""
    stored = df.sparkSession.table(name).schema
    align(df, stored).write.mode("append").format("parquet").saveAsTable(name)


def create_by_load(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """An empty table partitioned by its last column, `load`; an existing table is left alone."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (load)")


def replace_load(spark: SparkSession, df: DataFrame | None, name: str, load: str) -> None:
    """The rows of one load, and no others, become those of `df`: a load that is run again is there once."""
    held = load.replace("\\", "/").replace("'", "")
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (load = '{held}')")
    if df is not None:
        rows = align(df.withColumn("load", F.lit(held)), spark.table(name).schema)
        rows.write.mode("append").format("parquet").partitionBy("load").saveAsTable(name)


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_schema(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{path}'")


def drop_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def fresh_schema(spark: SparkSession, name: str, path: str) -> None:
    """An empty schema of that name; whatever it held is dropped."""
    drop_schema(spark, name)
    create_schema(spark, name, path)
