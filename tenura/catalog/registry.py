"""Query registry and the bound tables as SQL common table expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with equivalent SQL if there is any."""

    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def rounded(*cols: str, digits: int = 4) -> list[Column]:
    return [F.round(c, digits).alias(c) for c in cols]


# The subscriber tables of tenura.sources.bindings, in SQL.
BOUND = {
    "loan_assign": """loan_assign AS (
        SELECT CAST(o_custkey AS VARCHAR) AS bib_id,
               md5(CAST(o_custkey // 2 AS VARCHAR)) AS nid_hash,
               CAST(o_orderkey AS VARCHAR) AS loan_id,
               o_totalprice AS loan_amount, o_orderdate AS date_timestamp
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))""",
    "loan_recovery": """loan_recovery AS (
        SELECT CAST(o_custkey AS VARCHAR) AS bib_id, CAST(l_orderkey AS VARCHAR) AS loan_id,
               l_extendedprice AS loan_amount,
               l_extendedprice * (1 - l_discount) AS hsdp_recovery,
               l_shipdate AS date_timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')""",
    "package": """package AS (
        SELECT CAST(o_custkey AS VARCHAR) AS bib_id, CAST(l_partkey AS VARCHAR) AS offering_code,
               p_brand AS offering_name, l_extendedprice AS offer_amount,
               l_shipdate AS activation_date,
               l_shipdate + (CAST(l_quantity AS INTEGER) - 1) * INTERVAL 1 DAY
                   AS deactivation_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey)""",
    "recharge": """recharge AS (
        SELECT CAST(o_custkey AS VARCHAR) AS bib_id, o_totalprice AS recharge_value_amt,
               o_orderdate AS recharge_dt
        FROM orders)""",
    "recharge_timed": """recharge_timed AS (
        SELECT CAST(user_id AS VARCHAR) AS bib_id, value AS recharge_value_amt, ts AS recharge_dt
        FROM events WHERE event_type = 'purchase')""",
    "cdr": """cdr AS (
        SELECT CAST(user_id AS VARCHAR) AS bib_id,
               CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS sms_count,
               CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS voice_count,
               CASE WHEN event_type = 'view' THEN value ELSE 0 END AS call_duration,
               CASE WHEN event_type = 'click' THEN value ELSE 0 END AS gprs_usage
        FROM events)""",
    "subscriber": """subscriber AS (
        SELECT CAST(c_custkey AS VARCHAR) AS bib_id, c_mktsegment AS contract_type_v,
               CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS gender_v,
               CASE WHEN c_custkey % 10 <> 0 THEN CAST(first_order AS DATE) END
                   AS registration_date_d,
               CAST(DATE '1900-01-01' + CAST(c_custkey * 37 % 36500 AS INTEGER) AS DATE)
                   AS date_of_birth_d,
               CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS ability_status,
               c_acctbal AS account_balance
        FROM customer LEFT JOIN (
            SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey
        ) ON c_custkey = o_custkey)""",
}
BOUND["activity"] = """activity AS (
        SELECT bib_id, activation_date AS ts FROM package
        UNION ALL SELECT bib_id, recharge_dt FROM recharge)"""
BOUND["recharge_activity"] = "activity AS (SELECT bib_id, recharge_dt AS ts FROM recharge)"
BOUND["label"] = """label AS (
        SELECT bib_id, CASE WHEN lo IS NULL OR date_diff('day', CAST(hi AS DATE), CAST(lo AS DATE)) > 30
                            THEN 1 ELSE 0 END AS label
        FROM (SELECT bib_id, max(ts) AS hi FROM activity
              WHERE ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '1996-04-01' GROUP BY bib_id)
        LEFT JOIN (SELECT bib_id, min(ts) AS lo FROM activity
              WHERE ts >= TIMESTAMP '1996-04-01' AND ts < TIMESTAMP '1996-07-01' GROUP BY bib_id)
        USING (bib_id))"""


def bound_sql(select: str, *tables: str, more: str = "") -> str:
    """SELECT over bound tables; ``more`` holds further common table expressions."""
    parts = [BOUND[t] for t in tables] + ([more] if more else [])
    return "WITH " + ",\n".join(parts) + "\n" + select
