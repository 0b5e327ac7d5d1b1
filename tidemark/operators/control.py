"""Which tables are synced, and how."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.skew import key_join

# Sync modes of the control table.
PERIODIC_REFRESH = "periodic_refresh"
RELOAD_ONCE = "reload_once"
RELOAD_ALWAYS = "reload_always"


def configured_only(df: DataFrame, config: DataFrame, name: str) -> DataFrame:
    """Rows whose table is in the config."""
    return key_join(df, config, [name], "left_semi")


def control_modes(control: DataFrame, position: str) -> DataFrame:
    """One mode per table: rows with a blank field are skipped, the last row of a table wins.

    An aggregate with a partial step: many rows for one table collapse before the shuffle.
    """
    filled = [F.coalesce(F.col(c), F.lit("")) != "" for c in ("Table_Name", "Sync_Mode")]
    return (
        control.filter(filled[0] & filled[1])
        .groupBy("Table_Name")
        .agg(F.max_by("Sync_Mode", position).alias("Sync_Mode"))
    )


def resolve_modes(config: DataFrame, modes: DataFrame, name: str = "Table_Name") -> DataFrame:
    """Each configured table with its mode; a table without one is refreshed."""
    return config.join(modes, name, "left").withColumn(
        "Sync_Mode", F.coalesce("Sync_Mode", F.lit(PERIODIC_REFRESH))
    )


def reset_reload_once(control: DataFrame, tables: Iterable[str]) -> DataFrame:
    """The control table after a run: `reload_once` of the reloaded tables becomes a refresh."""
    done = F.col("Table_Name").isin(*tables) & (F.col("Sync_Mode") == RELOAD_ONCE)
    return control.withColumn("Sync_Mode", F.when(done, PERIODIC_REFRESH).otherwise(F.col("Sync_Mode")))
