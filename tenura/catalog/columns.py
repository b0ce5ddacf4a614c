"""Column rules and scalar functions."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tenura.catalog.registry import bound_sql, query
from tenura.functions.columns import (
    cap,
    categorize,
    categorize_durations,
    categorize_loans,
    categorize_recharges,
    fill_nulls,
    fill_zero,
    log_scale,
    parse_dates,
)
from tenura.operators.explore import value_counts
from tenura.operators.features import FEATURE_SETS, aggregate_features, user_attributes
from tenura.schemas import USAGE_FEATURES
from tenura.sources.bindings import AS_OF, StarSchema

STAMP = "yyyy-MM-dd HH:mm:ss"
SQL_STAMP = "%Y-%m-%d %H:%M:%S"


@query(
    "p1_parse_dates",
    f"""SELECT o_orderkey, strftime(o_orderdate, '{SQL_STAMP}') AS at,
               CASE WHEN o_orderkey % 10 > 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day
        FROM orders""",
)
def parse(spark, sf):
    """Valid, unreadable and empty date text."""
    at, key = F.col("o_orderdate"), F.col("o_orderkey")
    day = F.when(key % 10 == 0, "2024x").when(key % 10 == 1, "")
    text = StarSchema(spark, sf).raw("orders").select(
        "o_orderkey",
        F.date_format(at, "yyyyMMdd HH:mm:ss").alias("at"),
        day.otherwise(F.date_format(at, "yyyyMMdd")).alias("day"),
    )
    parsed = parse_dates(text, ["at"], ["day"])
    return parsed.select(
        "o_orderkey", F.date_format("at", STAMP).alias("at"), F.col("day").cast("string").alias("day")
    )


@query("p2_select_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def select_columns(spark, sf):
    return StarSchema(spark, sf).raw("orders").select("o_orderkey", "o_totalprice")


@query(
    "p3_add_and_replace_columns",
    """SELECT o_orderkey, round(o_totalprice * 2, 2) AS o_totalprice,
              lower(o_orderpriority) AS priority FROM orders""",
)
def add_columns(spark, sf):
    orders = StarSchema(spark, sf).raw("orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority"
    )
    added = orders.withColumns(
        {
            "o_totalprice": F.round(F.col("o_totalprice") * 2, 2),
            "priority": F.lower("o_orderpriority"),
        }
    )
    return added.drop("o_orderpriority")


@query("p4_drop_column", "SELECT c_custkey, c_acctbal FROM customer")
def drop_column(spark, sf):
    return StarSchema(spark, sf).raw("customer").drop("c_name", "c_nationkey", "c_mktsegment")


@query(
    "p5_null_tests_in_case",
    bound_sql(
        """SELECT bib_id, CASE WHEN gender_v IS NULL AND registration_date_d IS NOT NULL THEN 'a'
                  WHEN gender_v = 'F' OR account_balance > 5000 THEN 'b'
                  WHEN account_balance <= 0 THEN 'c' ELSE 'd' END AS kind
           FROM subscriber""",
        "subscriber",
    ),
)
def null_tests(spark, sf):
    gender, balance = F.col("gender_v"), F.col("account_balance")
    kind = (
        F.when(gender.isNull() & F.col("registration_date_d").isNotNull(), "a")
        .when((gender == "F") | (balance > 5000), "b")
        .when(balance <= 0, "c")
        .otherwise("d")
    )
    return StarSchema(spark, sf).user().select("bib_id", kind.alias("kind"))


@query(
    "p6_fill_numeric_with_zero",
    bound_sql(
        """SELECT bib_id, gender_v, coalesce(sms, 0) AS "SumSMSCount",
                  coalesce(voice, 0) AS "SumVoiceCount", coalesce(calls, 0) AS "SumCallDuration",
                  coalesce(gprs, 0) AS "SumGPRSUsage"
           FROM subscriber LEFT JOIN (
               SELECT bib_id, CAST(sum(sms_count) AS BIGINT) AS sms,
                      CAST(sum(voice_count) AS BIGINT) AS voice,
                      round(sum(call_duration), 4) AS calls, round(sum(gprs_usage), 4) AS gprs
               FROM cdr GROUP BY bib_id) USING (bib_id)""",
        "subscriber",
        "cdr",
    ),
)
def zero_filled(spark, sf):
    tables = StarSchema(spark, sf)
    usage = aggregate_features(tables.cdr(), FEATURE_SETS["cdr"])
    usage = usage.withColumns({c: F.round(c, 4) for c in ("SumCallDuration", "SumGPRSUsage")})
    joined = tables.user().select("bib_id", "gender_v").join(usage, "bib_id", "left")
    return fill_zero(joined, USAGE_FEATURES)


@query(
    "p7_fill_by_column",
    bound_sql(
        """SELECT bib_id, coalesce(gender_v, 'unknown') AS gender_v,
                  CAST(coalesce(year(registration_date_d), 1900) AS INTEGER) AS registration_year
           FROM subscriber""",
        "subscriber",
    ),
)
def filled_by_column(spark, sf):
    users = StarSchema(spark, sf).user().select(
        "bib_id", "gender_v", F.year("registration_date_d").alias("registration_year")
    )
    return fill_nulls(users, {"gender_v": "unknown", "registration_year": 1900})


@query(
    "p9_cap_age",
    bound_sql(
        """SELECT bib_id, round(least(date_diff('day', date_of_birth_d, DATE '2024-01-01')
                                      / 365.25, 100), 4) AS age FROM subscriber""",
        "subscriber",
    ),
)
def capped_age(spark, sf):
    users = user_attributes(StarSchema(spark, sf).user(), AS_OF)
    return users.select("bib_id", F.round(cap(F.col("age"), high=100.0), 4).alias("age"))


@query(
    "p10_range_labels",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 AND c_acctbal <= 1000 THEN 'small'
                              WHEN c_acctbal > 1000 AND c_acctbal <= 5000 THEN 'medium'
                              ELSE CAST(c_acctbal AS VARCHAR) END AS category
       FROM customer""",
)
def range_labels(spark, sf):
    """Balances outside the ranges keep their own text."""
    customers = StarSchema(spark, sf).raw("customer")
    labelled = categorize(customers, "c_acctbal", [0, 1000, 5000], ["small", "medium"])
    return labelled.select("c_custkey", "category")


def _cases(column: str, edges: list[int], names: list[str]) -> str:
    whens = [f"WHEN {column} <= {edge} THEN '{name}'" for edge, name in zip(edges, names)]
    return f"CASE {' '.join(whens)} ELSE '{names[-1]}' END"


DURATION_SQL = _cases(
    "days",
    [0, 1, 7, 15, 30, 60, 120, 180, 365],
    ["Same Day", "Daily", "Weekly", "Half-Monthly", "Monthly", "2 Months", "4 Months",
     "6 Months", "1 Year", "More than 1 Year"],
)


@query(
    "p11_duration_categories",
    bound_sql(
        f"""SELECT days AS time_difference_days, {DURATION_SQL} AS duration_category,
                   count(*) AS count
            FROM (SELECT date_diff('day', CAST(activation_date AS DATE),
                                   CAST(deactivation_date AS DATE)) AS days FROM package)
            GROUP BY ALL""",
        "package",
    ).replace("SELECT days AS", "SELECT CAST(days AS INTEGER) AS"),
)
def durations(spark, sf):
    labelled = categorize_durations(StarSchema(spark, sf).package())
    return value_counts(labelled, "time_difference_days", "duration_category")


@query(
    "p12_loan_categories",
    bound_sql(
        "SELECT loan_id, loan_amount, "
        + _cases(
            "loan_amount",
            [5000, 10000, 20000, 50000, 100000],
            ["VeryLow", "5T-10T", "10T-20T", "20T-50T", "50T-100T", "Extreme"],
        )
        + " AS loan_category FROM loan_assign",
        "loan_assign",
    ),
)
def loan_categories(spark, sf):
    labelled = categorize_loans(StarSchema(spark, sf).loan_assign())
    return labelled.select("loan_id", "loan_amount", "loan_category")


@query(
    "p13_recharge_categories",
    bound_sql(
        "SELECT bib_id, recharge_value_amt, "
        + _cases(
            "recharge_value_amt",
            [10000, 20000, 50000, 100000, 200000, 500000],
            ["1T", "2T", "5T", "10T", "20T", "50T", "More"],
        )
        + " AS recharge_category FROM recharge",
        "recharge",
    ),
)
def recharge_categories(spark, sf):
    labelled = categorize_recharges(StarSchema(spark, sf).recharge())
    return labelled.select("bib_id", "recharge_value_amt", "recharge_category")


@query(
    "f1_f2_text_to_time",
    f"""SELECT event_id, strftime(ts, '{SQL_STAMP}') AS at, strftime(ts, '%Y-%m-%d') AS day
        FROM events""",
)
def text_to_time(spark, sf):
    text = StarSchema(spark, sf).raw("events").select(
        "event_id",
        F.date_format("ts", "yyyyMMdd HH:mm:ss").alias("at"),
        F.date_format("ts", "yyyyMMdd").alias("day"),
    )
    parsed = text.withColumns(
        {
            "at": F.try_to_timestamp("at", F.lit("yyyyMMdd HH:mm:ss")),
            "day": F.try_to_date("day", "yyyyMMdd"),
        }
    )
    return parsed.select(
        "event_id", F.date_format("at", STAMP).alias("at"), F.col("day").cast("string").alias("day")
    )


@query(
    "f3_f4_f6_time_parts",
    """SELECT event_id, CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INTEGER) AS days,
              CAST(year(ts) AS INTEGER) AS year, CAST(hour(ts) AS INTEGER) AS hour,
              CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday, CAST(day(ts) AS INTEGER) AS day
       FROM events""",
)
def time_parts(spark, sf):
    end = F.lit(datetime.date(2024, 2, 1))
    return StarSchema(spark, sf).raw("events").select(
        "event_id",
        F.datediff(end, "ts").alias("days"),
        F.year("ts").alias("year"),
        F.hour("ts").alias("hour"),
        F.dayofweek("ts").alias("weekday"),
        F.dayofmonth("ts").alias("day"),
    )


@query(
    "f7_greatest_least",
    """SELECT o_orderkey, greatest(a, b) AS high, least(a, b) AS low
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS a,
                    CASE WHEN o_orderkey % 2 > 0 THEN 250000.0::DOUBLE END AS b FROM orders)""",
)
def greatest_least(spark, sf):
    key = F.col("o_orderkey")
    sides = StarSchema(spark, sf).raw("orders").select(
        "o_orderkey",
        F.when(key % 3 > 0, F.col("o_totalprice")).alias("a"),
        F.when(key % 2 > 0, F.lit(250000.0)).alias("b"),
    )
    return sides.select(
        "o_orderkey", F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    )


@query(
    "f8_m1_log_scale",
    """SELECT c_custkey, round(CASE WHEN c_acctbal > -1 THEN ln(1 + c_acctbal) END, 6) AS c_acctbal
       FROM customer""",
)
def logs(spark, sf):
    customers = StarSchema(spark, sf).raw("customer").select("c_custkey", "c_acctbal")
    return log_scale(customers, ["c_acctbal"]).withColumn("c_acctbal", F.round("c_acctbal", 6))


@query(
    "f5_f9_f10_age_and_case",
    bound_sql(
        """SELECT bib_id, round(date_diff('day', date_of_birth_d, DATE '2024-01-01') / 365.25, 4)
                          AS age,
                  CASE WHEN account_balance < 0 THEN -1 WHEN account_balance > 5000 THEN 1
                       ELSE 0 END AS side
           FROM subscriber""",
        "subscriber",
    ),
)
def age_and_case(spark, sf):
    balance = F.col("account_balance")
    return StarSchema(spark, sf).user().select(
        "bib_id",
        F.round(F.datediff(F.lit(AS_OF), "date_of_birth_d") / 365.25, 4).alias("age"),
        F.when(balance < 0, -1).when(balance > 5000, 1).otherwise(0).alias("side"),
    )
