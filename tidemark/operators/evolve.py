"""Schema differences, new columns and wider types. Names compare without letter case, as Spark resolves them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions import spark_type
from tidemark.operators.columns import Field
from tidemark.operators.skew import key_join


def schema_diff(declared: DataFrame, actual: DataFrame, name: str = "column_name") -> DataFrame:
    """Declared field rows whose name the actual field rows lack."""
    names = [F.lower(name).alias("_name")]
    missing = key_join(declared.select("*", *names), actual.select(*names), ["_name"], "left_anti")
    return missing.drop("_name")


def missing_fields(fields: Sequence[Field], schema: T.StructType) -> list[Field]:
    """The same difference for one table: declared fields the stored schema lacks, in declared order."""
    have = {n.lower() for n in schema.names}
    return [f for f in fields if f.name.lower() not in have]


def add_columns(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """`df` with the fields it lacks, null on every row."""
    new = missing_fields(fields, df.schema)
    return df.select("*", *[F.lit(None).cast(spark_type(f.type)).alias(f.name) for f in new])


KEEP, WIDEN, REFUSE = "keep", "widen", "refuse"
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


class TypeRefused(ValueError):
    """A declared type that cannot hold the stored values, nor the stored type the declared ones."""


@dataclass(frozen=True)
class TypeChange:
    """A stored column whose declared type is another: what becomes of it, and its type afterwards."""

    name: str
    stored: T.DataType
    declared: T.DataType
    action: str
    to: T.DataType | None


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both without loss, None where there is none.

    Integers widen to longer ones, to decimals with room for their digits, and up to 32 bits to doubles; decimals to those with
    more digits on both sides, up to 38; dates to times without zone; everything but times with a zone and nested types to text.
    """
    if a == b:
        return a
    kinds = {type(a), type(b)}
    if T.StringType in kinds:
        other = b if isinstance(a, T.StringType) else a
        plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampNTZType)
        return T.StringType() if isinstance(other, plain) else None
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if not (isinstance(a, T.NumericType) and isinstance(b, T.NumericType)):
        return None
    if a in _DIGITS and b in _DIGITS:
        return max(a, b, key=_DIGITS.__getitem__)
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(a, T.FractionalType) and isinstance(b, T.FractionalType) and T.DecimalType not in kinds:
        return None
    if T.DoubleType in kinds or T.FloatType in kinds:
        whole = a if a in _DIGITS else b
        return T.DoubleType() if _DIGITS.get(whole, 19) <= 10 else None
    digits = [(_DIGITS[t], 0) if t in _DIGITS else (t.precision - t.scale, t.scale) for t in (a, b)]
    before, behind = max(d[0] for d in digits), max(d[1] for d in digits)
    return T.DecimalType(before + behind, behind) if before + behind <= 38 else None


def type_changes(fields: Sequence[Field], schema: T.StructType) -> list[TypeChange]:
    """Stored columns with another declared type: the stored type is kept, widened, or the change refused."""
    declared = {f.name.lower(): spark_type(f.type) for f in fields}
    changes = []
    for f in schema:
        want = declared.get(f.name.lower(), f.dataType)
        if want != f.dataType:
            to = wider_type(f.dataType, want)
            action = REFUSE if to is None else KEEP if to == f.dataType else WIDEN
            changes.append(TypeChange(f.name, f.dataType, want, action, to))
    return changes


def widen_columns(df: DataFrame, changes: Sequence[TypeChange]) -> DataFrame:
    """`df` with its widened columns, values kept. Raises `TypeRefused`, which names them, if any change is refused."""
    refused = [f"{c.name} from {c.stored.simpleString()} to {c.declared.simpleString()}" for c in changes if c.action == REFUSE]
    if refused:
        raise TypeRefused(f"types cannot change: {', '.join(refused)}")
    to = {c.name: c.to for c in changes if c.action == WIDEN}
    return df.select(*[F.col(f"`{c}`").cast(to[c]).alias(c) if c in to else F.col(f"`{c}`") for c in df.columns])
