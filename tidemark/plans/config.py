"""Which tables are synced and by which columns."""

from __future__ import annotations

from dataclasses import dataclass

from tidemark.operators.ranges import CHUNK_RANGE


@dataclass(frozen=True)
class TableConfig:
    """Keys and dates of one table.

    `reduce` keeps the newest source row per key before the upsert; without it source keys must be unique.
    `batch_key` is the column whose ranges of `batch_range` keys form the chunks of a load.
    `layout_range` stores the target in chunks of so many values of the first key, so that a refresh rewrites only the
    chunks it touches; a key that is not an integer is stored in hash buckets. Choose it for some thousands of chunks.
    `skip_unchanged` compares staged rows with the target first: rows that it has already keep their load time, and chunks
    in which no row changes are not written.
    """

    table: str
    keys: tuple[str, ...]
    date_col: str
    batch_key: str | None = None
    batch_range: int = CHUNK_RANGE
    reduce: bool = True
    layout_range: int | None = None
    skip_unchanged: bool = False

    @property
    def chunk_key(self) -> str:
        return self.batch_key or self.keys[0]


#: The layout of the tables that grow without end.
LAYOUT_RANGE = 1_000_000

# Table, key columns, date column, chunk column where it is not the key.
TABLE_CONFIGS = {
    c.table: c
    for c in (
        TableConfig("Account", ("id",), "lastmodifieddate"),
        TableConfig("transactionLine", ("uniquekey",), "linelastmodifieddate", layout_range=LAYOUT_RANGE),
        TableConfig("AccountingPeriod", ("id",), "lastmodifieddate"),
        TableConfig("CUSTOMRECORD_360_COMMISSION_RULE", ("id",), "lastmodified"),
        TableConfig("CUSTOMRECORD_360_COMMISSION_TRACKING", ("id",), "lastmodified"),
        TableConfig("Quota", ("id", "date"), "date", reduce=False),
        TableConfig("classification", ("id",), "lastmodifieddate"),
        TableConfig("employee", ("id",), "lastmodifieddate"),
        TableConfig("entity", ("id",), "lastmodifieddate"),
        TableConfig("item", ("id",), "lastmodifieddate"),
        TableConfig("transaction", ("id",), "lastmodifieddate", layout_range=LAYOUT_RANGE),
        TableConfig("invoiceSalesTeam", ("id",), "lastmodifieddate", "transaction"),
        TableConfig("transactionSalesTeam", ("id",), "lastmodifieddate", "transaction"),
    )
}
