"""The six subscriber tables as views of an order, event and customer star schema.

Customers are subscribers: orders are their recharges and (urgent ones) their loans,
returned line items are loan recoveries, line items are packages, events are usage.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.schemas import TABLES
from tenura.sources.parquet import read_table

# Periods and reference date of the test bindings.
CURRENT_START = datetime.datetime(1996, 1, 1)
NEXT_START = datetime.datetime(1996, 4, 1)
NEXT_END = datetime.datetime(1996, 7, 1)
AS_OF = datetime.date(2024, 1, 1)
PERIOD_COLUMN = {
    "loan_assign": "date_timestamp",
    "loan_recovery": "date_timestamp",
    "package": "activation_date",
    "recharge": "recharge_dt",
}


class StarSchema:
    """Bound tables over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = read_table(self.spark, f"{self.folder}/{name}.parquet")
        return self._read[name]

    def loan_assign(self) -> DataFrame:
        urgent = self.raw("orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        return urgent.select(
            _text("o_custkey", "bib_id"),
            # Two neighbouring customers are one person with two subscriptions.
            F.md5(F.expr("CAST(o_custkey DIV 2 AS STRING)").cast("binary")).alias("nid_hash"),
            _text("o_orderkey", "loan_id"),
            F.col("o_totalprice").alias("loan_amount"),
            F.col("o_orderdate").alias("date_timestamp"),
        )

    def loan_recovery(self) -> DataFrame:
        returned = self.raw("lineitem").where(F.col("l_returnflag") == "R")
        return self._with_customer(returned).select(
            _text("o_custkey", "bib_id"),
            _text("l_orderkey", "loan_id"),
            F.col("l_extendedprice").alias("loan_amount"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("hsdp_recovery"),
            F.col("l_shipdate").alias("date_timestamp"),
        )

    def package(self) -> DataFrame:
        """Packages without their names, which need one join more."""
        return self._package(self._with_customer(self.raw("lineitem")))

    def named_package(self) -> DataFrame:
        items = self.raw("lineitem")
        parts = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        named = self._with_customer(items).join(parts, "l_partkey")
        return self._package(named, F.col("p_brand").alias("offering_name"))

    def recharge(self) -> DataFrame:
        return self.raw("orders").select(
            _text("o_custkey", "bib_id"),
            F.col("o_totalprice").alias("recharge_value_amt"),
            F.col("o_orderdate").alias("recharge_dt"),
        )

    def recharge_timed(self) -> DataFrame:
        """Recharges with times of day."""
        return self.raw("events").where(F.col("event_type") == "purchase").select(
            _text("user_id", "bib_id"),
            F.col("value").alias("recharge_value_amt"),
            F.col("ts").alias("recharge_dt"),
        )

    def cdr(self) -> DataFrame:
        def when(kind: str, value: Column, other: Column) -> Column:
            return F.when(F.col("event_type") == kind, value).otherwise(other)

        one, zero, value = F.lit(1), F.lit(0), F.col("value")
        return self.raw("events").select(
            _text("user_id", "bib_id"),
            when("click", one, zero).alias("sms_count"),
            when("view", one, zero).alias("voice_count"),
            when("view", value, F.lit(0.0)).alias("call_duration"),
            when("click", value, F.lit(0.0)).alias("gprs_usage"),
        )

    def user(self) -> DataFrame:
        first_order = (
            self.raw("orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.min("o_orderdate").alias("first_order"))
        )
        key = F.col("c_custkey")
        days = F.pmod(key * 37, F.lit(36500)).cast("int")
        gender = F.when(key % 3 == 0, "F").when(key % 3 == 1, "M")
        return self.raw("customer").join(first_order, "c_custkey", "left").select(
            _text("c_custkey", "bib_id"),
            F.col("c_mktsegment").alias("contract_type_v"),
            gender.alias("gender_v"),
            F.when(key % 10 != 0, F.to_date("first_order")).alias("registration_date_d"),
            F.date_add(F.lit(datetime.date(1900, 1, 1)), days).alias("date_of_birth_d"),
            F.when(key % 2 == 0, "A").otherwise("B").alias("ability_status"),
            F.col("c_acctbal").alias("account_balance"),
        )

    def order_rows(self) -> DataFrame:
        """Recharges, and the loans among them: one scan of the orders for both."""
        urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        return self.raw("orders").select(
            _text("o_custkey", "bib_id"),
            F.col("o_totalprice").alias("recharge_value_amt"),
            F.col("o_orderdate").alias("recharge_dt"),
            F.col("o_totalprice").alias("loan_amount"),
            urgent.alias("is_loan"),
        )

    def item_rows(self) -> DataFrame:
        """Packages, and the recoveries among them: one scan of the line items for both."""
        items = self._with_customer(self.raw("lineitem"))
        return self._package(
            items,
            F.col("l_extendedprice").alias("loan_amount"),
            (F.col("l_returnflag") == "R").alias("is_recovery"),
        )

    def sources(self) -> list[tuple[DataFrame, dict[str, str | None], str | None]]:
        """All tables as few sources: rows, the tables they belong to, and their time column."""
        return [
            (self.item_rows(), {"package": None, "loan_recovery": "is_recovery"}, "activation_date"),
            (self.order_rows(), {"recharge": None, "loan_assign": "is_loan"}, "recharge_dt"),
            (self.cdr(), {"cdr": None}, None),
            (self.user(), {"user": None}, None),
        ]

    def tables(self, names: Iterable[str] = TABLES) -> dict[str, DataFrame]:
        return {name: getattr(self, name)() for name in names}

    def period(self, start: datetime.datetime, end: datetime.datetime) -> dict[str, DataFrame]:
        """All tables, the dated ones limited to [start, end)."""
        return {
            name: within(df, PERIOD_COLUMN[name], start, end) if name in PERIOD_COLUMN else df
            for name, df in self.tables().items()
        }

    def _with_customer(self, items: DataFrame) -> DataFrame:
        owners = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        return items.join(owners, "l_orderkey")

    def _package(self, items: DataFrame, *more: Column) -> DataFrame:
        days = (F.col("l_quantity") - 1).cast("int")
        return items.select(
            _text("o_custkey", "bib_id"),
            _text("l_partkey", "offering_code"),
            F.col("l_extendedprice").alias("offer_amount"),
            F.col("l_shipdate").alias("activation_date"),
            (F.col("l_shipdate") + F.make_dt_interval(days)).alias("deactivation_date"),
            *more,
        )


def within(
    df: DataFrame, column: str, start: datetime.datetime, end: datetime.datetime
) -> DataFrame:
    """Rows whose timestamp is in [start, end)."""
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))


def _text(column: str, name: str) -> Column:
    return F.col(column).cast("string").alias(name)
