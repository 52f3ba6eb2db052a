"""The query catalog: each operator run over the supplied tables, with its SQL answer beside it."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, ShortType, TimestampNTZType, TimestampType

from ledgerlake.operators.dimensions import calendar_of
from ledgerlake.plans import bank_view, warehouse
from ledgerlake.plans.oracle import sql
from ledgerlake.plans.warehouse import StoredTables
from ledgerlake.session import shared_folder

# The last day of the account data: accounts without an entry are placed on it.
LAST_DAY = dt.date(2001, 8, 1)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ANSWERS: dict[str, str] = {}

_LAYERS: dict[tuple[str, str, str], StoredTables] = {}


class Bank:
    """The supplied folder as a bank: its tables, and the layers stored from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return bank_view.table(self.spark, self.folder, name)

    def event(self, name: str) -> DataFrame:
        return bank_view.event(self.spark, self.folder, name)

    @property
    def root(self) -> str:
        """A folder of this application and input, on storage all executors share."""
        mark = hashlib.sha256(self.folder.encode()).hexdigest()[:12]
        return f"{shared_folder(self.spark)}/{self.spark.sparkContext.applicationId}/{mark}"

    def schema(self, layer: str) -> str:
        """A catalog schema of this input's own."""
        return f"l{hashlib.sha256(self.folder.encode()).hexdigest()[:12]}_{layer}"

    def scratch(self, name: str) -> str:
        return f"{self.root}/scratch/{name}"

    def _layer(self, name: str, make: Callable[[], StoredTables]) -> StoredTables:
        """A layer is stored once per application and input, table by table, as it is used."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _LAYERS:
            _LAYERS[key] = make()
        return _LAYERS[key]

    def _warehouse(self) -> StoredTables:
        """Dimensions and facts; each is stored, with what it needs, when it is first asked for."""
        return warehouse.gold_layer(
            self.raw, self.silver, lambda: self.calendar, self.root, LAST_DAY, all_active=False
        )

    @property
    def raw(self) -> StoredTables:
        makers = {
            name: (lambda name=name: bank_view.raw(self.spark, self.folder, name)) for name in bank_view.RAW_SQL
        }
        return self._layer("raw", lambda: StoredTables(makers, f"{self.root}/bronze"))

    @property
    def silver(self) -> StoredTables:
        """Cleaned straight from the views over the supplied tables: raw text is stored only for queries that read it as such."""
        return self._layer("silver", lambda: warehouse.silver_layer(warehouse.Plans(self.raw), self.root))

    @property
    def gold(self) -> StoredTables:
        return self._layer("gold", self._warehouse)

    def clean(self, name: str) -> DataFrame:
        """A clean table as a plan over the raw ones, not stored."""
        return warehouse.silver(self.raw)[name]()

    def mart(self, name: str) -> DataFrame:
        return warehouse.mart_views(self.gold)[name]()

    @property
    def days(self) -> DataFrame:
        orders = self.table("orders").select(F.col("o_orderdate").cast("date").alias("d"))
        return orders.unionAll(self.table("lineitem").select(F.col("l_shipdate").cast("date")))

    @property
    def calendar(self) -> DataFrame:
        return calendar_of(self.days, "d")


def plain(df: DataFrame) -> DataFrame:
    """Amounts as doubles and days as text, so that results compare across engines."""
    columns = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, DecimalType):
            column = column.cast("double")
        elif isinstance(kind, DateType):
            column = column.cast("string")
        elif isinstance(kind, (TimestampType, TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, ShortType):
            column = column.cast("int")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, answer: str | None = None, optional: tuple[str, ...] = ()):
    """Register a query under a name, with the SQL that gives the same answer.

    Whole numbers that may be missing (`optional`) are published as doubles, since
    result sets differ in how they hold a missing integer.
    """

    def add(make: Callable[[Bank], DataFrame]) -> Callable[[Bank], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = plain(make(Bank(spark, folder)))
            return df.withColumns({c: F.col(c).cast("double") for c in optional}) if optional else df

        QUERIES[name] = run
        if answer is not None:
            casts = ", ".join(f"{c}::double as {c}" for c in optional)
            ANSWERS[name] = sql(f"select * replace ({casts}) from ({answer})" if optional else answer)
        return make

    return add


def load() -> None:
    """Import the query modules, which register themselves."""
    from ledgerlake.plans import (  # noqa: F401
        queries_catalogs,
        queries_cleaning,
        queries_history,
        queries_marts,
        queries_quality,
        queries_published,
        queries_series,
        queries_star,
        queries_tables,
    )
