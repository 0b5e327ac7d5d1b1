import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions.types import declared_type
from tidemark.functions import (
    clean_boolean,
    clean_date,
    clean_float,
    clean_integer,
    clean_timestamp,
    normalized_type,
    parse_us_date,
    spark_type,
    storage_type,
    us_date_text,
)


def apply(spark, cleaner, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["c"] for r in df.select("i", cleaner(F.col("v")).alias("c")).orderBy("i").collect()]


def by_hand(text, form):
    try:
        return dt.datetime.strptime(text, form)
    except (ValueError, TypeError):
        return None


DATES = [
    ("01/05/2024", dt.date(2024, 1, 5)),
    ("1/5/2024", dt.date(2024, 1, 5)),
    ("1/ 5/2024", dt.date(2024, 1, 5)),
    ("12/31/2024", dt.date(2024, 12, 31)),
    ("2/29/2024", dt.date(2024, 2, 29)),
    ("2/29/2023", None),
    ("4/31/2024", None),
    ("2024-01-05", None),
    ("13/01/2024", None),
    ("02/30/2024", None),
    ("12/31/99", None),
    ("001/05/2024", None),
    ("01/05/02024", None),
    ("01/05/0000", None),
    ("01/05/0001", dt.date(1, 1, 5)),
    ("", None),
    (" 01/05/2024", None),
    ("01/05/2024 ", None),
    ("01/05/2024\n", None),
    (None, None),
]


def test_dates(spark):
    assert apply(spark, clean_date, [v for v, _ in DATES]) == [d for _, d in DATES]


def test_dates_agree_with_strptime(spark):
    parts = st.tuples(st.integers(0, 14), st.integers(0, 33), st.sampled_from([0, 1, 99, 1900, 2000, 2023, 2024, 9999]))
    forms = st.sampled_from(["{}/{}/{:04d}", "{:02d}/{:02d}/{:04d}", "{}/{:2d}/{:04d}", "{:02d}/{}/{}", "{}-{}-{:04d}", "{}/{}/{:04d}x"])
    seen = set()

    @settings(max_examples=2000, deadline=None, database=None)
    @given(parts, forms)
    def gather(p, f):
        seen.add(f.format(*p))

    gather()
    texts = sorted(seen)
    expected = [d and d.date() for d in (by_hand(t, "%m/%d/%Y") for t in texts)]
    assert apply(spark, clean_date, texts) == expected


def test_booleans(spark):
    values = ["T", "F", "true", "false", "t", "no", "x", "", None]
    assert apply(spark, clean_boolean, values) == [True, False, True, False, True, False, None, None, None]


def test_booleans_agree_with_the_cast(spark):
    values = ["T", "F", " yes ", "Y", "N", "0", "1", "TRUE", "faLse", "2", "tr", "on"]
    cast = apply(spark, lambda c: c.try_cast("boolean"), values)
    assert apply(spark, clean_boolean, values) == cast


def test_timestamps(spark):
    cases = [
        ("2022-01-01", dt.datetime(2022, 1, 1)),
        ("2022-01-01 10:11:12", dt.datetime(2022, 1, 1, 10, 11, 12)),
        ("2022-1-1 1:2:3", dt.datetime(2022, 1, 1, 1, 2, 3)),
        ("2022-01-01  10:11:12", dt.datetime(2022, 1, 1, 10, 11, 12)),
        ("2022-01- 1", dt.datetime(2022, 1, 1)),
        ("2022-1-1", None),
        ("2022-01-01T10:11:12", None),
        ("2022-01-01 24:00:00", None),
        ("2022-01-01 10:11:60", None),
        ("2022-02-30", None),
        ("2023-02-29", None),
        ("01/02/2022", None),
        ("later", None),
        (None, None),
    ]
    assert apply(spark, clean_timestamp, [v for v, _ in cases]) == [t for _, t in cases]


def test_integers_and_floats(spark):
    values = ["12", "-3", "+4", " 5 ", "x", "1.5", "", "9223372036854775807", "9223372036854775808", None]
    assert apply(spark, clean_integer, values) == [12, -3, 4, 5, None, None, None, 2**63 - 1, None, None]
    values = ["1", "1.5", "-.5", "1e3", "2.", "x", "", "1,5", None]
    assert apply(spark, clean_float, values) == [1.0, 1.5, -0.5, 1000.0, 2.0, None, None, None, None]
    assert apply(spark, clean_float, ["Infinity", "-inf"]) == [float("inf"), float("-inf")]


def test_numbers_agree_with_the_cast(spark):
    values = ["0", "007", "-0", "+", "-", "1 2", "1e5", "0x1F", "١", "1_000", "\t8\n"]
    assert apply(spark, clean_integer, values) == apply(spark, lambda c: c.try_cast("bigint"), values)


def test_type_names(spark):
    declared = ["STRING(2000)", "NUMERIC(10, 2)", "NUMERIC(10,2)", "NUMERIC(10)", "()", "None", "", None, "DATE", "boolean"]
    assert apply(spark, normalized_type, declared) == [
        "STRING", "FLOAT", "FLOAT", "NUMERIC(10)", None, None, None, None, "DATE", "BOOLEAN",
    ]
    odd = [" string(20)", "None ", " () ", "none", "numeric(3, 1)", "Numeric", "geography"]
    assert apply(spark, normalized_type, declared + odd) == [declared_type(t) for t in declared + odd]
    stored = ["FLOAT", "integer", "BOOLEAN", "STRING", "DATETIME", "GEOGRAPHY", None]
    assert apply(spark, storage_type, stored) == ["FLOAT64", "INT64", "BOOL", "STRING", "DATETIME", "GEOGRAPHY", None]


def test_spark_types():
    assert spark_type("INTEGER").simpleString() == "bigint"
    assert spark_type("string(20)").simpleString() == "string"
    assert spark_type("NUMERIC(10, 2)").simpleString() == "double"
    assert spark_type("DATETIME").simpleString() == "timestamp_ntz"
    assert spark_type("NUMERIC").simpleString() == "decimal(38,9)"
    assert [spark_type(t).simpleString() for t in ("INT64", "float64", "BOOL")] == ["bigint", "double", "boolean"]
    with pytest.raises(ValueError):
        spark_type("()")


def test_us_date_text_round_trip(spark):
    assert apply(spark, lambda c: us_date_text(parse_us_date(c)), ["01/05/2024", "12/31/1999"]) == ["01/05/2024", "12/31/1999"]
