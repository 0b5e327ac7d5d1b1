"""Registered queries: every operator and job on the test tables, each beside the SQL it must agree with.

The common setting is a sync on a given day: the target holds what earlier syncs saw (rows dated before the
day), the source holds what changed since some days before it, so that the two overlap.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import (
    clean_boolean,
    clean_date,
    clean_integer,
    clean_timestamp,
    normalized_type,
    storage_type,
    us_date_text,
)
from tidemark.operators import audit, columns, control, dedupe, evolve, presence, ranges, reconcile, upsert
from tidemark.operators.columns import Field, conform, declared_fields, declared_schema, fields_of
from tidemark.plans import jobs, store
from tidemark.plans.config import TableConfig
from tidemark.sources import drift, pages, sinks, tables
from tidemark.streaming import stream_refresh
from tidemark.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DAY = dt.date(2000, 1, 1)
EVENTS_DAY = dt.date(2024, 1, 29)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql:
            ORACLES[key] = sql
        return function

    return register


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# ---------------------------------------------------------------- reads


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def landed_pages_explode(spark, sf):
    events = _read(spark, sf, "events")
    landed = new_folder(spark, "landed")
    pages.land_pages(events.withColumn("ts", F.col("ts").cast("string")), landed)
    row = events.schema
    return pages.read_pages(spark, landed, row)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def full_scan_project(spark, sf):
    fields = [Field("c_custkey", "INTEGER"), Field("c_name", "STRING"), Field("c_acctbal", "FLOAT")]
    return tables.full_scan(_read(spark, sf, "customer"), fields)


@query("SELECT * FROM lineitem")
def full_scan_star(spark, sf):
    return tables.full_scan(_read(spark, sf, "lineitem"))


@query("SELECT * FROM events WHERE ts >= DATE '2024-01-29' - 2")
def recent_window(spark, sf):
    return ranges.recent_window(_read(spark, sf, "events"), "ts", EVENTS_DAY)


@query(
    """
    SELECT event_id, strftime(ts, '%m/%d/%Y') AS day_text, CAST(ts AS DATE) - 2 AS window_start FROM events
    """
)
def window_dates(spark, sf):
    events = _read(spark, sf, "events")
    day = F.to_date("ts")
    return events.select("event_id", us_date_text(day).alias("day_text"), F.date_sub(day, 2).alias("window_start"))


@query(
    """
    WITH b AS (SELECT MIN(o_orderkey) AS lo, MAX(o_orderkey) + 1 AS hi FROM orders)
    SELECT o.* FROM orders o, b
    WHERE o_orderkey >= lo + (hi - lo) // 4 AND o_orderkey < lo + 3 * ((hi - lo) // 4)
    """
)
def key_range_scan(spark, sf):
    orders = _read(spark, sf, "orders")
    span = orders.agg(F.min("o_orderkey").alias("lo"), (F.max("o_orderkey") + 1).alias("hi"))
    quarter = F.expr("(hi - lo) div 4")
    lower = span.select((F.col("lo") + quarter).alias("k")).scalar()
    upper = span.select((F.col("lo") + 3 * quarter).alias("k")).scalar()
    return ranges.sorted_key_range(orders, "o_orderkey", lower, upper)


@query("SELECT * FROM lineitem WHERE l_orderkey = 42")
def point_lookup(spark, sf):
    return ranges.point_lookup(_read(spark, sf, "lineitem"), "l_orderkey", 42)


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000 OFFSET 2000")
def page_slice(spark, sf):
    return ranges.page(_read(spark, sf, "orders"), ["o_orderkey"], 2)


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET (SELECT COUNT(*) // 200 * 100 FROM orders)")
def page_in_the_middle(spark, sf):
    orders = _read(spark, sf, "orders")
    return ranges.page_by_key(orders, "o_orderkey", orders.count() // 200, 100, most_skipped=100)


@query("SELECT MIN(o_orderkey) AS min_key, MAX(o_orderkey) AS max_key FROM orders")
def key_bounds(spark, sf):
    return ranges.key_bounds(_read(spark, sf, "orders"), "o_orderkey")


@query("SELECT l_orderkey FROM lineitem ORDER BY l_orderkey DESC LIMIT 1")
def top1_key(spark, sf):
    return ranges.top_key(_read(spark, sf, "lineitem"), "l_orderkey")


@query("SELECT l_orderkey FROM lineitem ORDER BY l_orderkey LIMIT 1")
def bottom1_key(spark, sf):
    return ranges.top_key(_read(spark, sf, "lineitem"), "l_orderkey", descending=False)


@query(
    """
    WITH b AS (SELECT MIN(l_orderkey) AS lo, MAX(l_orderkey) + 1 AS hi FROM lineitem),
    g AS (SELECT UNNEST(range(lo, hi, 1000)) AS lower, lo, hi FROM b),
    c AS (SELECT (l_orderkey - lo) // 1000 AS chunk_id, COUNT(*) AS n_rows FROM lineitem, b GROUP BY ALL)
    SELECT (lower - lo) // 1000 AS chunk_id, lower, LEAST(lower + 1000, hi) AS upper, COALESCE(n_rows, 0) AS n_rows
    FROM g LEFT JOIN c ON c.chunk_id = (lower - lo) // 1000
    """
)
def key_chunks(spark, sf):
    return ranges.chunk_counts(_read(spark, sf, "lineitem"), "l_orderkey", 1000)


@query(
    """
    SELECT o_orderkey, (o_orderkey - (SELECT MIN(o_orderkey) FROM orders)) // 1000 AS chunk_id FROM orders
    """
)
def key_chunk_rows(spark, sf):
    orders = _read(spark, sf, "orders")
    return ranges.with_chunks(orders, "o_orderkey", 1000).select("o_orderkey", "chunk_id")


@query("SELECT l_orderkey, CAST((row_number() OVER (ORDER BY l_orderkey) - 1) // 1000 AS BIGINT) AS page_id FROM lineitem")
def page_grid(spark, sf):
    return ranges.page_grid(_read(spark, sf, "lineitem"), ["l_orderkey"]).select("l_orderkey", "page_id")


@query("SELECT COUNT(*) AS n_rows, true AS without_gaps, true AS balanced FROM lineitem")
def equal_depth_chunks(spark, sf):
    # Squared, the keys are so unevenly spread that chunks of equal width are not of equal depth.
    skewed = _read(spark, sf, "lineitem").select((F.col("l_orderkey") * F.col("l_orderkey")).alias("key"))
    chunks = ranges.equal_depth_bounds(skewed, "key", 16)
    bounds = F.sort_array(F.collect_list("lower")), F.sort_array(F.collect_list("upper"))
    return chunks.agg(
        F.sum("n_rows").alias("n_rows"),
        (F.slice(bounds[0], F.lit(2), F.size(bounds[0])) == F.slice(bounds[1], F.lit(1), F.size(bounds[1]) - 1)).alias("without_gaps"),
        (F.max("n_rows") <= 2 * F.sum("n_rows") / 16).alias("balanced"),
    )


# ---------------------------------------------------------------- writes


@query("SELECT * REPLACE (CASE WHEN o_orderdate >= DATE '2000-01-01' THEN o_orderpriority END AS o_orderpriority) FROM orders")
def append_batches(spark, sf):
    orders = _read(spark, sf, "orders")
    name = _table(spark, "orders_appended", orders.schema)
    recent = F.coalesce(F.col("o_orderdate") >= DAY, F.lit(False))
    sinks.append(orders.filter(recent), name)
    sinks.append(orders.filter(~recent).drop("o_orderpriority"), name)
    return spark.table(name)


@query(
    """
    SELECT * EXCLUDE (l_tax, l_linestatus), l_tax, l_linestatus FROM
    (SELECT * EXCLUDE (l_tax) FROM lineitem WHERE l_returnflag = 'R'
     UNION ALL BY NAME SELECT * EXCLUDE (l_linestatus) FROM lineitem WHERE l_returnflag IS DISTINCT FROM 'R')
    """
)
def page_concat(spark, sf):
    lines = _read(spark, sf, "lineitem")
    returned = F.col("l_returnflag").eqNullSafe("R")
    return columns.concat_pages(lines.filter(returned).drop("l_tax"), lines.filter(~returned).drop("l_linestatus"))


@query(
    """
    SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders WHERE o_orderdate >= DATE '2000-01-01' - 365
    """
)
def replace_table(spark, sf):
    orders = _read(spark, sf, "orders")
    name = _target(spark, "orders", orders.schema)
    store.update_target(_seen_orders(orders), name)
    store.replace_target(_changed_orders(orders), name)
    return store.read_target(spark, name)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def declared_schema_table(spark, sf):
    rows = [
        {"Column Name": "c_custkey", "Data Type": "INTEGER", "Nullable": "NULLABLE"},
        {"Column Name": "c_name", "Data Type": "STRING(2000)", "Nullable": "NULLABLE"},
        {"Column Name": "c_acctbal", "Data Type": "NUMERIC(10, 2)", "Nullable": "NULLABLE"},
        {"Column Name": "c_unused", "Data Type": "()", "Nullable": "NULLABLE"},
    ]
    name = _table(spark, "customer_declared", declared_schema(declared_fields(rows)))
    sinks.append(_read(spark, sf, "customer"), name)
    return spark.table(name)


@query("SELECT * FROM supplier")
def clone_table_schema(spark, sf):
    supplier = _read(spark, sf, "supplier")
    first = _table(spark, "supplier_first", supplier.schema)
    sinks.append(supplier, first)
    second = f"{first}_clone"
    sinks.clone_table(spark, second, first, new_folder(spark, "clone"))
    sinks.append(spark.table(first), second)
    return spark.table(second)


@query("SELECT * FROM customer WHERE c_acctbal < 0")
def truncate_staging(spark, sf):
    customer = _read(spark, sf, "customer")
    schema, folder = f"staging_{uuid.uuid4().hex[:12]}", new_folder(spark, "staging")
    sinks.fresh_schema(spark, schema, folder)
    name = f"{schema}.customer_staging"
    sinks.create_table(spark, name, customer.schema)
    sinks.append(customer, name)
    sinks.truncate(spark, name)
    sinks.append(customer.filter("c_acctbal < 0"), name)
    return spark.table(name)


@query("SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM customer")
def stamp_load_ts(spark, sf):
    return columns.stamp_load(_read(spark, sf, "customer"), _moment("2024-01-01 00:00:00"))


# ---------------------------------------------------------------- upserts

_SEEN = "SELECT * FROM orders WHERE o_orderdate < DATE '2000-01-01'"
_CHANGED = """SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders
              WHERE o_orderdate >= DATE '2000-01-01' - 365"""


def _seen_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderdate") < DAY)


def _changed_orders(orders: DataFrame) -> DataFrame:
    return ranges.recent_window(orders, "o_orderdate", DAY, 365).withColumn("o_totalprice", F.col("o_totalprice") * 2)


@query(
    f"""
    WITH t AS ({_SEEN}), s AS ({_CHANGED})
    SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s
    """
)
def merge_upsert_plain(spark, sf):
    orders = _read(spark, sf, "orders")
    return upsert.upsert(_seen_orders(orders), _changed_orders(orders), ["o_orderkey"])


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_TIES = [
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


def _latest_lines(rows: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
               {', '.join(LINE_TIES)}) AS rn FROM ({rows})) WHERE rn = 1"""


@query(_latest_lines("SELECT * FROM lineitem"))
def latest_per_key(spark, sf):
    return dedupe.latest_per_key(_read(spark, sf, "lineitem"), LINE_KEY, "l_shipdate", LINE_TIES)


@query(
    f"""
    WITH t AS (SELECT * REPLACE (0.0::DOUBLE AS l_quantity) FROM (
                 {_latest_lines("SELECT * FROM lineitem WHERE l_shipdate < DATE '2000-01-01'")})),
    s AS ({_latest_lines("SELECT * FROM lineitem WHERE l_shipdate >= DATE '2000-01-01' - 365")})
    SELECT * FROM t WHERE NOT EXISTS (
        SELECT 1 FROM s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)
    UNION ALL SELECT * FROM s
    """
)
def merge_upsert_latest(spark, sf):
    lines = _read(spark, sf, "lineitem")
    seen = lines.filter(F.col("l_shipdate") < DAY)
    target = dedupe.latest_per_key(seen, LINE_KEY, "l_shipdate", LINE_TIES).withColumn("l_quantity", F.lit(0.0))
    changed = ranges.recent_window(lines, "l_shipdate", DAY, 365)
    return upsert.upsert_latest(target, changed, LINE_KEY, "l_shipdate", LINE_TIES)


@query(
    f"""
    WITH t AS ({_latest_lines("SELECT * FROM lineitem WHERE l_linestatus = 'F'")}),
    s AS ({_latest_lines("SELECT * FROM lineitem WHERE l_linestatus = 'O'")})
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = t.l_orderkey
        AND s.l_linenumber = t.l_linenumber AND s.l_shipdate >= t.l_shipdate)
    UNION ALL
    SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE s.l_orderkey = t.l_orderkey
        AND s.l_linenumber = t.l_linenumber AND s.l_shipdate < t.l_shipdate)
    """
)
def merge_upsert_newer(spark, sf):
    lines = _read(spark, sf, "lineitem")
    target = dedupe.latest_per_key(lines.filter("l_linestatus = 'F'"), LINE_KEY, "l_shipdate", LINE_TIES)
    source = lines.filter("l_linestatus = 'O'")
    return upsert.upsert_latest(target, source, LINE_KEY, "l_shipdate", LINE_TIES, only_if_newer=True)


@query(
    f"""
    WITH t AS ({_SEEN}), s AS (SELECT * EXCLUDE (o_orderpriority) FROM ({_CHANGED}))
    SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
           t.o_orderpriority
    FROM t FULL JOIN s ON s.o_orderkey = t.o_orderkey
    """
)
def merge_upsert_some_columns(spark, sf):
    orders = _read(spark, sf, "orders")
    return upsert.upsert(_seen_orders(orders), _changed_orders(orders).drop("o_orderpriority"), ["o_orderkey"])


@query(
    """
    WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, value FROM events),
    t AS (SELECT user_id, day, COUNT(*) AS n, MAX(value) AS top FROM d WHERE ts < DATE '2024-01-20' GROUP BY ALL),
    s AS (SELECT user_id, day, COUNT(*) AS n, MIN(value) AS top FROM d WHERE ts >= DATE '2024-01-10' GROUP BY ALL)
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.user_id = t.user_id AND s.day = t.day)
    UNION ALL SELECT * FROM s
    """
)
def merge_upsert_composite(spark, sf):
    daily = _read(spark, sf, "events").withColumn("day", F.to_date("ts"))
    old = daily.filter(F.col("ts") < dt.date(2024, 1, 20)).groupBy("user_id", "day")
    new = daily.filter(F.col("ts") >= dt.date(2024, 1, 10)).groupBy("user_id", "day")
    target = old.agg(F.count("*").alias("n"), F.max("value").alias("top"))
    source = new.agg(F.count("*").alias("n"), F.min("value").alias("top"))
    return upsert.upsert_unique(target, source, ["user_id", "day"])


@query(
    """
    WITH s AS (SELECT l_orderkey, l_returnflag, l_tax, ROW_NUMBER() OVER (PARTITION BY l_orderkey
                 ORDER BY l_shipdate DESC, l_returnflag, l_tax) AS rn FROM lineitem)
    SELECT o.*, s.l_returnflag, s.l_tax FROM orders o LEFT JOIN s ON s.l_orderkey = o.o_orderkey AND s.rn = 1
    """
)
def backfill_new_columns(spark, sf):
    lines = _read(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    new = [Field("l_returnflag", "STRING"), Field("l_tax", "FLOAT")]
    target = evolve.add_columns(_read(spark, sf, "orders"), new)
    return upsert.fill_columns(target, lines, ["o_orderkey"], [f.name for f in new], "l_shipdate")


@query("SELECT DISTINCT * FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F')")
def exact_dedupe(spark, sf):
    orders = _read(spark, sf, "orders")
    return dedupe.drop_exact_duplicates(columns.concat_pages(orders, orders.filter("o_orderstatus = 'F'")))


# ---------------------------------------------------------------- cleaning

_DATE_TEXT = """CASE l_linenumber WHEN 1 THEN strftime(l_shipdate, '%m/%d/%Y') WHEN 2 THEN strftime(l_shipdate, '%-m/%-d/%Y')
    WHEN 3 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 4 THEN '02/30/2024' WHEN 5 THEN 'soon' WHEN 6 THEN ''
    ELSE NULL END"""


def _line_text(spark: SparkSession, sf: str, text: Column) -> DataFrame:
    return _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("text"))


def _variants(*texts: Column) -> Column:
    """The n-th text on lines numbered n, null on the rest."""
    number = F.col("l_linenumber")
    chosen = F.when(number == 1, texts[0])
    for i, text in enumerate(texts[1:], start=2):
        chosen = chosen.when(number == i, text)
    return chosen


def _cleaned_lines(lines: DataFrame, cleaner: Callable[[Column], Column]) -> DataFrame:
    return lines.select("l_orderkey", "l_linenumber", cleaner(F.col("text")).alias("cleaned"))


@query(
    f"SELECT l_orderkey, l_linenumber, CAST(try_strptime({_DATE_TEXT}, '%m/%d/%Y') AS DATE) AS cleaned FROM lineitem",
    name="clean_date",
)
def clean_date_text(spark, sf):
    day = F.col("l_shipdate")
    text = _variants(
        F.date_format(day, "MM/dd/yyyy"),
        F.date_format(day, "M/d/yyyy"),
        F.date_format(day, "yyyy-MM-dd"),
        F.lit("02/30/2024"),
        F.lit("soon"),
        F.lit(""),
    )
    return _cleaned_lines(_line_text(spark, sf, text), clean_date)


@query(
    """
    SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN l_quantity > 25 WHEN 2 THEN l_quantity <= 25
        WHEN 3 THEN TRUE WHEN 4 THEN FALSE END AS cleaned FROM lineitem
    """,
    name="clean_boolean",
)
def clean_boolean_text(spark, sf):
    big = F.col("l_quantity") > 25
    text = _variants(
        F.when(big, "T").otherwise("F"), F.when(big, "F").otherwise("T"), F.lit("true"), F.lit("false"), F.lit("x")
    )
    return _cleaned_lines(_line_text(spark, sf, text), clean_boolean)


@query(
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 2 THEN l_shipdate
        WHEN l_linenumber = 3 THEN l_shipdate + INTERVAL 11 HOUR + INTERVAL 5 SECOND END AS cleaned FROM lineitem
    """,
    name="clean_timestamp",
)
def clean_timestamp_text(spark, sf):
    day = F.col("l_shipdate")
    text = _variants(
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 11:00:05")),
        F.date_format(day, "MM/dd/yyyy"),
        F.lit("later"),
    )
    return _cleaned_lines(_line_text(spark, sf, text), clean_timestamp)


@query(
    """
    SELECT l_orderkey, l_linenumber, TRY_CAST(CASE l_linenumber WHEN 1 THEN CAST(l_partkey AS VARCHAR)
        WHEN 2 THEN '-' || CAST(l_partkey AS VARCHAR) WHEN 3 THEN 'x' || CAST(l_partkey AS VARCHAR)
        WHEN 4 THEN '' END AS BIGINT) AS cleaned FROM lineitem
    """,
    name="clean_integer",
)
def clean_integer_text(spark, sf):
    part = F.col("l_partkey").cast("string")
    text = _variants(part, F.concat(F.lit("-"), part), F.concat(F.lit("x"), part), F.lit(""))
    return _cleaned_lines(_line_text(spark, sf, text), clean_integer)


@query(
    """
    WITH r AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN ' string(' || l_partkey || ')'
        WHEN 2 THEN 'NUMERIC(' || l_suppkey || ', 2)' WHEN 3 THEN 'NUMERIC(' || l_suppkey || ')'
        WHEN 4 THEN ' () ' WHEN 5 THEN 'none' WHEN 6 THEN 'boolean ' ELSE 'Numeric' END AS t FROM lineitem),
    d AS (SELECT l_orderkey, l_linenumber, upper(trim(t)) AS t FROM r),
    n AS (SELECT l_orderkey, l_linenumber, CASE WHEN regexp_full_match(t, 'STRING\\(\\d+\\)') THEN 'STRING'
        WHEN regexp_full_match(t, 'NUMERIC\\(\\d+,\\s*\\d+\\)') THEN 'FLOAT' ELSE t END AS declared
        FROM d WHERE t NOT IN ('', '()', 'NONE'))
    SELECT *, CASE upper(declared) WHEN 'FLOAT' THEN 'FLOAT64' WHEN 'INTEGER' THEN 'INT64' WHEN 'BOOLEAN' THEN 'BOOL'
        ELSE declared END AS stored FROM n
    """
)
def normalize_types(spark, sf):
    supplier = F.col("l_suppkey").cast("string")
    text = _variants(
        F.concat(F.lit(" string("), F.col("l_partkey").cast("string"), F.lit(")")),
        F.concat(F.lit("NUMERIC("), supplier, F.lit(", 2)")),
        F.concat(F.lit("NUMERIC("), supplier, F.lit(")")),
        F.lit(" () "),
        F.lit("none"),
        F.lit("boolean "),
        F.lit("Numeric"),
    )
    lines = _line_text(spark, sf, text)
    declared = lines.select("l_orderkey", "l_linenumber", normalized_type(F.col("text")).alias("declared"))
    return declared.filter("declared IS NOT NULL").withColumn("stored", storage_type(F.col("declared")))


ORDER_FIELDS = fields_of(
    """
    o_orderkey INTEGER
    o_custkey INTEGER
    o_totalprice FLOAT
    o_orderdate DATE
    is_final BOOLEAN
    o_orderpriority STRING
    updated_at DATETIME
    """
)


def _order_text(orders: DataFrame) -> DataFrame:
    """Orders the way a landed page carries them: text in every column."""
    return orders.select(
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        F.col("o_totalprice").cast("string"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("o_orderdate"),
        F.when(F.col("o_orderstatus") == "F", "T").otherwise("F").alias("is_final"),
        "o_orderpriority",
    )


_ORDER_COLUMNS = """o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
    o_orderstatus = 'F' AS is_final, o_orderpriority"""


@query(f"SELECT {_ORDER_COLUMNS}, CAST(NULL AS DOUBLE) AS margin FROM orders")
def conform_to_schema(spark, sf):
    return conform(_order_text(_read(spark, sf, "orders")), [*ORDER_FIELDS, Field("margin", "FLOAT")])


# ---------------------------------------------------------------- audit


@query("SELECT COUNT(*) AS n_rows FROM events WHERE ts >= DATE '2024-01-29' - 2")
def filtered_count(spark, sf):
    recent = F.col("ts") >= F.date_sub(F.lit(EVENTS_DAY), 2)
    return audit.filtered_count(_read(spark, sf, "events"), recent)


_AUDIT = """
    WITH r AS (SELECT l_orderkey // 1000 AS chunk_id, l_orderkey // 10 AS batch_id,
        NOT (l_quantity = 50 AND l_returnflag = 'R') AS good FROM lineitem),
    b AS (SELECT chunk_id, batch_id, COUNT(*) AS n, BOOL_AND(good) AS good FROM r GROUP BY ALL),
    a AS (SELECT chunk_id, COUNT(*) AS batches, CAST(COALESCE(SUM(n) FILTER (good), 0) AS BIGINT) AS uploaded,
        CAST(COALESCE(SUM(n) FILTER (NOT good), 0) AS BIGINT) AS failed, BOOL_AND(good) AS succeeded FROM b GROUP BY ALL)
"""


def _line_audit(spark, sf) -> DataFrame:
    """Audit of lines whose key text is spoiled where 50 pieces were returned."""
    spoiled = (F.col("l_quantity") == 50) & (F.col("l_returnflag") == "R")
    key = F.col("l_orderkey").cast("string")
    landed = _read(spark, sf, "lineitem").select(
        "l_orderkey", F.when(spoiled, F.concat(F.lit("#"), key)).otherwise(key).alias("key_text")
    )
    parts = landed.select(
        ranges.chunk_of(F.col("l_orderkey"), F.lit(0), 1000).alias("chunk_id"),
        ranges.chunk_of(F.col("l_orderkey"), F.lit(0), 10).alias("batch_id"),
        clean_integer(F.col("key_text")).isNotNull().alias("good"),
    )
    return audit.load_audit(parts, "chunk_id", "batch_id", F.col("good"))


@query(f"{_AUDIT} SELECT * FROM a")
def load_audit(spark, sf):
    return _line_audit(spark, sf)


@query(
    f"""{_AUDIT} SELECT CAST(SUM(batches) AS BIGINT) AS batches, CAST(SUM(uploaded) AS BIGINT) AS uploaded,
    CAST(SUM(failed) AS BIGINT) AS failed, BOOL_AND(succeeded) AS succeeded FROM a"""
)
def load_audit_total(spark, sf):
    return audit.audit_total(_line_audit(spark, sf))


# ---------------------------------------------------------------- control and evolution


@query("SELECT * FROM lineitem SEMI JOIN (SELECT s_suppkey AS l_suppkey FROM supplier WHERE s_acctbal > 0) USING (l_suppkey)")
def configured_tables(spark, sf):
    config = _read(spark, sf, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return control.configured_only(_read(spark, sf, "lineitem"), config, "l_suppkey").select(
        *_read(spark, sf, "lineitem").columns
    )


@query(
    """
    WITH control AS (SELECT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS t, o_orderkey AS position,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'reload_once' WHEN '2-HIGH' THEN 'reload_always'
        WHEN '3-MEDIUM' THEN 'periodic_refresh' WHEN '4-NOT SPECIFIED' THEN '' END AS mode FROM orders),
    modes AS (SELECT t, arg_max(mode, position) AS mode FROM control WHERE COALESCE(mode, '') <> '' GROUP BY t)
    SELECT c_name AS Table_Name, COALESCE(mode, 'periodic_refresh') AS Sync_Mode FROM customer LEFT JOIN modes ON t = c_name
    """
)
def sync_mode_resolve(spark, sf):
    priority = F.col("o_orderpriority")
    rows = _read(spark, sf, "orders").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("Table_Name"),
        F.when(priority == "1-URGENT", control.RELOAD_ONCE)
        .when(priority == "2-HIGH", control.RELOAD_ALWAYS)
        .when(priority == "3-MEDIUM", control.PERIODIC_REFRESH)
        .when(priority == "4-NOT SPECIFIED", "")
        .alias("Sync_Mode"),
        F.col("o_orderkey").alias("position"),
    )
    config = _read(spark, sf, "customer").select(F.col("c_name").alias("Table_Name"))
    return control.resolve_modes(config, control.control_modes(rows, "position"))


@query(
    """
    SELECT c_name AS column_name, c_mktsegment AS data_type FROM customer
    WHERE lower(c_name) NOT IN (SELECT lower(c_name) FROM customer WHERE c_acctbal >= 0)
    """
)
def schema_diff(spark, sf):
    customer = _read(spark, sf, "customer")
    declared = customer.select(F.col("c_name").alias("column_name"), F.col("c_mktsegment").alias("data_type"))
    stored = customer.filter("c_acctbal >= 0").select(F.upper("c_name").alias("column_name"))
    return evolve.schema_diff(declared, stored)


@query("SELECT *, CAST(NULL AS DOUBLE) AS margin FROM orders")
def evolve_add_columns(spark, sf):
    return evolve.add_columns(_read(spark, sf, "orders"), [Field("O_CUSTKEY", "INTEGER"), Field("margin", "FLOAT")])


# ---------------------------------------------------------------- jobs

FIRST_LOAD = "2024-01-01 00:00:00"
SECOND_LOAD = "2024-01-01 02:00:00"


def _schema() -> str:
    return f"sync_{uuid.uuid4().hex[:12]}"


def _table(spark: SparkSession, name: str, schema) -> str:
    """A new empty table in a schema of its own."""
    folder = new_folder(spark, "tables")
    db = _schema()
    sinks.create_schema(spark, db, folder)
    sinks.create_table(spark, f"{db}.{name}", schema)
    return f"{db}.{name}"


def _target(spark: SparkSession, name: str, schema, layout: store.Layout | None = None) -> str:
    folder = new_folder(spark, "targets")
    db = _schema()
    sinks.create_schema(spark, db, folder)
    store.create_target(spark, f"{db}.{name}", schema, f"{folder}/{name}", layout)
    return f"{db}.{name}"


def _run(spark: SparkSession, moment: str = FIRST_LOAD) -> jobs.Run:
    return jobs.open_run(spark, _schema(), DAY, _moment(moment))


def _later(run: jobs.Run, **changes) -> jobs.Run:
    return replace(run, load_ts=_moment(SECOND_LOAD), **changes)


def _priced(orders: DataFrame, factor: int) -> DataFrame:
    return orders.withColumn("o_totalprice", F.col("o_totalprice") * factor)


_FULL = f"SELECT {_ORDER_COLUMNS}, TIMESTAMP '{FIRST_LOAD}' AS updated_at FROM orders"
_REFRESHED = f"""
    SELECT {_ORDER_COLUMNS}, TIMESTAMP '{FIRST_LOAD}' AS updated_at FROM orders WHERE o_orderdate < DATE '2000-01-01' - 60
    UNION ALL
    SELECT {_ORDER_COLUMNS}, TIMESTAMP '{SECOND_LOAD}' AS updated_at FROM (
        SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders WHERE o_orderdate >= DATE '2000-01-01' - 60)
"""


@query(_FULL)
def full_load(spark, sf):
    run = _run(spark)
    config = TableConfig("orders", ("o_orderkey",), "o_orderdate")
    jobs.full_load(run, config, ORDER_FIELDS, _order_text(_read(spark, sf, "orders")))
    jobs.close_run(run)
    return store.read_target(spark, run.target(config))


_BAD_DATE = "o_orderkey % 7 = 0"
_BAD_ROW = "o_orderkey % 11 = 3"


@query(
    f"""
    SELECT * REPLACE (CASE WHEN {_BAD_DATE} THEN NULL ELSE o_orderdate END AS o_orderdate) FROM ({_FULL})
    WHERE {_BAD_DATE} OR o_orderdate >= DATE '2000-01-01' - 60
    """
)
def refresh_bad_dates(spark, sf):
    """Rows whose date text cannot be read may be recent: they arrive, without the date."""
    text = _order_text(_read(spark, sf, "orders"))
    broken = F.when(F.col("o_orderkey").cast("bigint") % 14 == 0, F.lit("2000-01-02")).otherwise(F.lit("soon"))
    text = text.withColumn("o_orderdate", F.when(F.expr(_BAD_DATE), broken).otherwise(F.col("o_orderdate")))
    run = replace(_run(spark), lookback_days=60)
    config = TableConfig("orders", ("o_orderkey",), "o_orderdate")
    jobs.refresh(run, config, ORDER_FIELDS, text)
    jobs.close_run(run)
    return store.read_target(spark, run.target(config))


@query(
    f"""
    SELECT 'loaded' AS what, o_orderkey AS key, o_totalprice AS amount FROM orders WHERE NOT ({_BAD_ROW})
    UNION ALL SELECT 'rejected', o_orderkey, NULL FROM orders WHERE {_BAD_ROW}
    UNION ALL SELECT 'audited', o_orderkey // 100000, COUNT(*) FILTER ({_BAD_ROW}) FROM orders GROUP BY ALL
    """
)
def load_with_rejects(spark, sf):
    """Unreadable rows do not stop a load: they are stored as rejects, and the audit counts them by chunk."""
    text = _order_text(_read(spark, sf, "orders"))
    text = text.withColumn("o_totalprice", F.when(F.expr(_BAD_ROW), F.lit("much")).otherwise(F.col("o_totalprice").cast("string")))
    run = _run(spark)
    config = TableConfig("orders", ("o_orderkey",), "o_orderdate")
    jobs.full_load(run, config, ORDER_FIELDS, text)
    jobs.close_run(run)
    loaded = store.read_target(spark, run.target(config)).select(
        F.lit("loaded").alias("what"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount")
    )
    key = F.get_json_object("row", "$.o_orderkey").cast("bigint").alias("key")
    rejected = spark.table(run.rejects).select(F.lit("rejected").alias("what"), key)
    audited = spark.table(run.audits).select(
        F.lit("audited").alias("what"), F.col("chunk_id").alias("key"), F.col("failed").cast("double").alias("amount")
    )
    return columns.concat_pages(loaded, rejected, audited)


def _refreshed(spark, sf, config: TableConfig) -> DataFrame:
    orders = _read(spark, sf, "orders")
    run = _run(spark)
    jobs.full_load(run, config, ORDER_FIELDS, _order_text(_seen_orders(orders)))
    later = _later(run, lookback_days=60)
    jobs.refresh(later, config, ORDER_FIELDS, _order_text(_priced(orders, 2)))
    jobs.close_run(run)
    return store.read_target(spark, run.target(config))


@query(_REFRESHED)
def incremental_refresh(spark, sf):
    return _refreshed(spark, sf, TableConfig("orders", ("o_orderkey",), "o_orderdate"))


@query(_REFRESHED)
def incremental_refresh_by_chunk(spark, sf):
    orders = _read(spark, sf, "orders")
    last = ranges.key_bounds(orders, "o_orderkey").first()["max_key"]
    return _refreshed(spark, sf, TableConfig("orders", ("o_orderkey",), "o_orderdate", layout_range=last // 20 + 1))


@query(f"SELECT {_ORDER_COLUMNS}, TIMESTAMP '{FIRST_LOAD}' AS updated_at FROM orders")
def column_backfill(spark, sf):
    orders = _order_text(_read(spark, sf, "orders"))
    run = _run(spark)
    config = TableConfig("orders", ("o_orderkey",), "o_orderdate")
    jobs.full_load(run, config, [f for f in ORDER_FIELDS if f.name not in ("is_final", "o_custkey")], orders)
    jobs.backfill(run, config, ORDER_FIELDS, orders)
    jobs.close_run(run)
    return store.read_target(spark, run.target(config))


CUSTOMER_FIELDS = fields_of(
    """
    c_custkey INTEGER
    c_name STRING
    c_acctbal FLOAT
    c_since DATE
    updated_at DATETIME
    """
)


@query(
    f"""
    SELECT 'orders' AS table_name, o_orderkey AS key, o_totalprice AS amount, updated_at FROM ({_REFRESHED})
    UNION ALL SELECT 'customer', c_custkey, c_acctbal * 2, TIMESTAMP '{SECOND_LOAD}' FROM customer
    UNION ALL SELECT 'control', position, NULL, NULL FROM
        (VALUES (1, 'periodic_refresh'), (2, 'periodic_refresh')) v(position, mode) WHERE mode = 'periodic_refresh'
    """
)
def sync_mode_run(spark, sf):
    orders, customer = _read(spark, sf, "orders"), _read(spark, sf, "customer").withColumn("c_since", F.lit("1/2/1999"))
    configs = {
        "orders": TableConfig("orders", ("o_orderkey",), "o_orderdate"),
        "customer": TableConfig("customer", ("c_custkey",), "c_since"),
    }
    run = _run(spark)
    jobs.full_load(run, configs["orders"], ORDER_FIELDS, _order_text(_seen_orders(orders)))
    jobs.full_load(run, configs["customer"], CUSTOMER_FIELDS, customer)
    modes = spark.createDataFrame(
        [("orders", control.PERIODIC_REFRESH, 1), ("customer", control.RELOAD_ONCE, 2)],
        "Table_Name string, Sync_Mode string, position bigint",
    )
    modes_table = f"{run.schema}.sync_modes"
    store.create_target(spark, modes_table, modes.schema, f"{run.root}/sync_modes")
    store.update_target(modes, modes_table)
    doubled = customer.withColumn("c_acctbal", F.col("c_acctbal") * 2)
    sources = {
        "orders": jobs.Source(ORDER_FIELDS, _order_text(_priced(orders, 2))),
        "customer": jobs.Source(CUSTOMER_FIELDS, doubled),
    }
    jobs.sync_by_table(_later(run, lookback_days=60), configs, sources, modes_table, "position")
    jobs.close_run(run)
    synced = [
        store.read_target(spark, run.target(configs["orders"])).select(
            F.lit("orders").alias("table_name"),
            F.col("o_orderkey").alias("key"),
            F.col("o_totalprice").alias("amount"),
            "updated_at",
        ),
        store.read_target(spark, run.target(configs["customer"])).select(
            F.lit("customer").alias("table_name"),
            F.col("c_custkey").alias("key"),
            F.col("c_acctbal").alias("amount"),
            "updated_at",
        ),
        store.read_target(spark, modes_table)
        .filter(F.col("Sync_Mode") == control.PERIODIC_REFRESH)
        .select(F.lit("control").alias("table_name"), F.col("position").alias("key")),
    ]
    return columns.concat_pages(*synced)


EVENT_FIELDS = fields_of(
    """
    event_id INTEGER
    ts DATETIME
    user_id INTEGER
    event_type STRING
    value FLOAT
    updated_at DATETIME
    """
)


@query(
    f"""
    SELECT event_id, date_trunc('second', ts) AS ts, user_id, event_type, value, TIMESTAMP '{FIRST_LOAD}' AS updated_at
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """
)
def stream_refresh_latest(spark, sf):
    events = _read(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "user_id", "event_type", "value"
    )
    landed = new_folder(spark, "landed")
    for turn in range(5):
        pages.land_pages(events.filter(F.pmod(F.xxhash64("event_id"), F.lit(5)) == turn), landed)
    run = _run(spark)
    config = TableConfig("events", ("user_id", "event_type"), "event_id")
    stream = stream_refresh(run, config, EVENT_FIELDS, landed, new_folder(spark, "progress"), files_per_batch=3)
    stream.awaitTermination()
    jobs.close_run(run)
    return store.read_target(spark, run.target(config))


# ---------------------------------------------------------------- source and target compared

#: Orders that a target has lost, holds with another price, or holds though the source has none such.
_LOST, _STALE, _STRAY = "o_orderkey % 1013 = 5", "o_orderkey % 1511 = 7", "o_orderkey % 1999 = 3"
_SPOILED = f"""
    SELECT * REPLACE (CASE WHEN {_STALE} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders
    WHERE NOT {_LOST} UNION ALL SELECT * REPLACE (-o_orderkey AS o_orderkey) FROM orders WHERE {_STRAY}
"""


def _spoiled_orders(spark, sf) -> tuple[DataFrame, DataFrame]:
    orders = _read(spark, sf, "orders")
    price = F.when(F.expr(_STALE), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    strays = orders.filter(_STRAY).withColumn("o_orderkey", -F.col("o_orderkey"))
    return orders, orders.withColumn("o_totalprice", price).filter(f"NOT {_LOST}").unionByName(strays)


_BY_100 = "CAST(floor(o_orderkey / 100) AS BIGINT) * 100"


@query(
    f"""
    WITH t AS ({_SPOILED}),
    bad AS (SELECT {_BY_100} AS lower FROM (FROM orders EXCEPT ALL FROM t UNION ALL (FROM t EXCEPT ALL FROM orders)) GROUP BY ALL),
    a AS (SELECT {_BY_100} AS lower, COUNT(*) AS n FROM orders GROUP BY ALL), b AS (SELECT {_BY_100} AS lower, COUNT(*) AS n FROM t GROUP BY ALL)
    SELECT lower, lower + 100 AS upper, COALESCE(a.n, 0) AS source_rows, COALESCE(b.n, 0) AS target_rows
    FROM bad LEFT JOIN a USING (lower) LEFT JOIN b USING (lower)
    """
)
def reconcile_chunks(spark, sf):
    return reconcile.differing_chunks(*_spoiled_orders(spark, sf), ["o_orderkey"], width=100)


@query(
    f"""
    SELECT o_orderkey, CASE WHEN {_LOST} THEN 'missing' ELSE 'changed' END AS what FROM orders WHERE {_LOST} OR {_STALE}
    UNION ALL SELECT -o_orderkey, 'extra' FROM orders WHERE {_STRAY}
    """
)
def reconcile_rows(spark, sf):
    return reconcile.differing_rows(*_spoiled_orders(spark, sf), ["o_orderkey"], width=100)


@query("SELECT l_orderkey FROM lineitem ANTI JOIN (SELECT o_orderkey AS l_orderkey FROM orders WHERE o_orderkey % 97 <> 11) USING (l_orderkey) GROUP BY ALL")
def departed_keys(spark, sf):
    orders = _read(spark, sf, "orders").filter("o_orderkey % 97 <> 11")
    return presence.departed_keys(_read(spark, sf, "lineitem"), orders, "l_orderkey", "o_orderkey")


def _loaded(spark, target: DataFrame, **more) -> tuple[jobs.Run, TableConfig]:
    """A run with a chunked target of these orders."""
    run = _run(spark)
    last = ranges.key_bounds(target, "o_orderkey").first()["max_key"]
    config = TableConfig("orders", ("o_orderkey",), "o_orderdate", layout_range=last // 20 + 1, batch_range=1000, **more)
    jobs.full_load(run, config, ORDER_FIELDS, _order_text(target))
    return run, config


@query(
    f"""
    SELECT {_ORDER_COLUMNS}, CASE WHEN o_orderdate >= DATE '2000-01-01' - 60 AND {_STALE}
        THEN TIMESTAMP '{SECOND_LOAD}' ELSE TIMESTAMP '{FIRST_LOAD}' END AS updated_at FROM orders
    WHERE o_orderdate >= DATE '2000-01-01' - 60 OR NOT {_STALE}
    UNION ALL SELECT {_ORDER_COLUMNS}, TIMESTAMP '{FIRST_LOAD}' FROM (SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders)
    WHERE o_orderdate < DATE '2000-01-01' - 60 AND {_STALE}
    """
)
def refresh_skips_unchanged(spark, sf):
    """Only the recent rows that differ get a new load time; the others and the older ones keep theirs."""
    orders = _read(spark, sf, "orders")
    price = F.when(F.expr(_STALE), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    run, config = _loaded(spark, orders.withColumn("o_totalprice", price), skip_unchanged=True)
    jobs.refresh(_later(run, lookback_days=60), config, ORDER_FIELDS, _order_text(orders))
    jobs.close_run(run)
    return store.read_target(spark, run.target(config))


@query(
    f"""
    SELECT {_ORDER_COLUMNS}, CASE WHEN {_LOST} OR {_STALE} THEN TIMESTAMP '{SECOND_LOAD}' ELSE TIMESTAMP '{FIRST_LOAD}' END AS updated_at
    FROM orders
    """
)
def repair_target(spark, sf):
    orders, spoiled = _spoiled_orders(spark, sf)
    run, config = _loaded(spark, spoiled)
    jobs.repair(_later(run), config, ORDER_FIELDS, _order_text(orders))
    jobs.close_run(run)
    return store.read_target(spark, run.target(config))


@query(f"SELECT * FROM ({_FULL}) WHERE o_orderkey % 97 <> 11")
def remove_departed(spark, sf):
    orders = _read(spark, sf, "orders")
    run, config = _loaded(spark, orders)
    jobs.remove_departed(run, config, orders.filter("o_orderkey % 97 <> 11").select("o_orderkey"))
    jobs.close_run(run)
    return store.read_target(spark, run.target(config))


@query(
    f"""
    SELECT * REPLACE (CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(is_final AS VARCHAR) AS is_final) FROM ({_REFRESHED})
    """
)
def refresh_widens_types(spark, sf):
    """Columns declared as text after the first load become text; what they hold stays."""
    orders = _read(spark, sf, "orders")
    config, run = TableConfig("orders", ("o_orderkey",), "o_orderdate"), _run(spark)
    jobs.full_load(run, config, ORDER_FIELDS, _order_text(_seen_orders(orders)))
    fields = [replace(f, type="STRING") if f.name in ("o_custkey", "is_final") else f for f in ORDER_FIELDS]
    later = _order_text(_priced(orders, 2)).withColumn("is_final", F.when(F.col("is_final") == "T", "true").otherwise("false"))
    jobs.refresh(_later(run, lookback_days=60), config, fields, later)
    jobs.close_run(run)
    return store.read_target(spark, run.target(config))


@query(
    """
    SELECT 'note' AS name, 'undeclared' AS drift, 'STRING' AS seen, COUNT(*) AS n_cells FROM events WHERE event_id % 5 = 0 HAVING COUNT(*) > 0
    UNION ALL SELECT 'value', 'conflict', 'OBJECT', COUNT(*) FROM events WHERE event_id % 11 = 0 HAVING COUNT(*) > 0
    UNION ALL SELECT 'user_id', 'conflict', 'BOOLEAN', COUNT(*) FROM events WHERE event_id % 13 = 0 HAVING COUNT(*) > 0
    UNION ALL SELECT 'ts', 'absent', NULL, 0
    """
)
def page_drift(spark, sf):
    def is_(remainder: str) -> Column:
        return F.expr(f"event_id % {remainder}")

    def item(user: Column, value: Column) -> Column:
        note = F.when(is_("5 = 0"), F.lit("new")).alias("note")
        return F.to_json(F.struct("event_id", "event_type", note, user.alias("user_id"), value.alias("value")))

    odd_user, odd_value = F.lit(True), F.struct(F.lit(1).alias("amount"))
    user, value = F.col("user_id"), F.col("value")
    both = F.when(is_("13 = 0") & is_("11 = 0"), item(odd_user, odd_value)).when(is_("13 = 0"), item(odd_user, value))
    landed = new_folder(spark, "landed")
    texts = _read(spark, sf, "events").select(both.when(is_("11 = 0"), item(user, odd_value)).otherwise(item(user, value)).alias("item"))
    texts.select(F.concat(F.lit('{"items":['), "item", F.lit("]}")).alias("value")).write.text(landed)
    return drift.page_drift(spark, landed, EVENT_FIELDS)
