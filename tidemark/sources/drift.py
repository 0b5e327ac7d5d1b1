"""What landed pages hold that their declaration does not say."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions import spark_type
from tidemark.operators.columns import STAMP, Field

UNDECLARED, CONFLICT, ABSENT = "undeclared", "conflict", "absent"
#: What each item carries besides its columns.
LINKS = "links"
_NESTED = ("OBJECT", "ARRAY")


def _unreadable(kind: T.DataType, seen: Column) -> Column:
    """Whether JSON values of a kind can never be read as the declared type. Text may be; the cleaners tell by the cell."""
    if isinstance(kind, T.StringType):
        return seen.isin(*_NESTED)
    fits = ["STRING", "VOID"]
    if isinstance(kind, T.BooleanType):
        fits += ["BOOLEAN"]
    elif isinstance(kind, T.IntegralType):
        fits += ["BIGINT"]
    elif isinstance(kind, T.NumericType):
        fits += ["BIGINT", "DECIMAL", "DOUBLE"]
    return ~seen.isin(*fits)


def page_drift(spark: SparkSession, path: str, fields: Sequence[Field]) -> DataFrame:
    """How the pages under `path`, one a line, differ from the declared fields: name, drift, seen, n_cells.

    `undeclared`: a name that is not declared, once for each kind of JSON value seen under it. `conflict`: values of a kind that
    the declared type never reads, such as objects or a fraction for an INTEGER. `absent`: a declared name that no item has, with
    no kind and 0 cells. Names compare without letter case and are told in small letters. Pages are read as VARIANT, so whatever
    is in them is seen; a broken page fails the read, an empty line or a page without items adds nothing. One aggregate, combined
    before its shuffle.
    """
    pages = spark.read.text(path).filter(F.trim("value") != "").select(F.parse_json("value").alias("page"))
    items = pages.select(F.explode(F.variant_get("page", "$.items", "array<variant>")).alias("item"))
    cells = items.lateralJoin(spark.tvf.variant_explode(F.col("item").outer())).select(
        F.lower("key").alias("name"),
        F.regexp_extract(F.schema_of_variant("value"), "^[A-Z_]+", 0).alias("seen"),
    )
    counts = cells.filter(F.col("name") != LINKS).groupBy("name", "seen").agg(F.count("*").alias("n_cells"))
    declared = {f.name.lower(): spark_type(f.type) for f in fields if f.name.lower() != STAMP}
    drift = F.when(~F.col("name").isin(*declared), UNDECLARED)
    for name, kind in declared.items():
        drift = drift.when((F.col("name") == name) & _unreadable(kind, F.col("seen")), CONFLICT)
    # One row for each declared name, against one for each name and kind seen.
    all_names = spark.createDataFrame([(n,) for n in declared], "name string")
    absent = all_names.join(counts.select("name"), "name", "left_anti").select(
        "name", F.lit(ABSENT).alias("drift"), F.lit(None).cast("string").alias("seen"), F.lit(0).cast("bigint").alias("n_cells")
    )
    return counts.select("name", drift.alias("drift"), "seen", "n_cells").filter("drift is not null").unionByName(absent)
