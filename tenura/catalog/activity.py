"""Labels, populations and joins of activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.catalog.registry import bound_sql, query
from tenura.operators.activity import (
    activity_bound,
    activity_rows,
    churn_label,
    churn_label_between,
    churn_labels,
    combine_outer,
    package_recharge_activity,
    scoring_population,
)
from tenura.operators.explore import common_values, recovered_rows
from tenura.sources.bindings import (
    CURRENT_START,
    NEXT_END,
    NEXT_START,
    StarSchema,
    within,
)

STAMP = "yyyy-MM-dd HH:mm:ss"
SQL_STAMP = "%Y-%m-%d %H:%M:%S"


def activity_of_star(star: StarSchema) -> DataFrame:
    return package_recharge_activity(star.package(), star.recharge())


def activity(spark: SparkSession, sf: str) -> DataFrame:
    return activity_of_star(StarSchema(spark, sf))


def label_of_star(star: StarSchema) -> DataFrame:
    limits = [F.lit(t) for t in (CURRENT_START, NEXT_START, NEXT_END)]
    return churn_label_between(activity_of_star(star), *limits)


def label(spark: SparkSession, sf: str) -> DataFrame:
    return label_of_star(StarSchema(spark, sf))


query(
    "l1_churn_label",
    bound_sql("SELECT bib_id, label FROM label", "package", "recharge", "activity", "label"),
)(label)


@query(
    "l1_churn_label_recharge_only",
    bound_sql(
        "SELECT bib_id, label FROM label",
        "recharge",
        "recharge_activity",
        "label",
    ),
)
def label_from_recharges(spark, sf):
    recharge = StarSchema(spark, sf).recharge()
    limits = [F.lit(t) for t in (CURRENT_START, NEXT_START, NEXT_END)]
    return churn_label_between(activity_rows([(recharge, "recharge_dt")]), *limits)


@query(
    "l2_label_of_period_pair",
    bound_sql("SELECT bib_id, label FROM label", "package", "recharge", "activity", "label"),
)
def label_of_pair(spark, sf):
    rows = activity(spark, sf)
    current = within(rows, "ts", CURRENT_START, NEXT_START)
    return churn_label(current, within(rows, "ts", NEXT_START, NEXT_END))


@query(
    "l3_labels_of_consecutive_periods",
    bound_sql(
        """SELECT c.month, c.bib_id,
                  CASE WHEN n.lo IS NULL
                         OR date_diff('day', CAST(c.hi AS DATE), CAST(n.lo AS DATE)) > 30
                       THEN 1 ELSE 0 END AS label
           FROM bounds c LEFT JOIN bounds n ON n.bib_id = c.bib_id AND n.q = c.q + 1
           WHERE c.q < 2001 * 4 + 3""",
        "package",
        "recharge",
        "activity",
        more="""bounds AS (
            SELECT bib_id, year(ts) * 4 + quarter(ts) - 1 AS q,
                   year(ts) || 'Q' || quarter(ts) AS month, max(ts) AS hi, min(ts) AS lo
            FROM activity GROUP BY ALL)""",
    ),
)
def consecutive_labels(spark, sf):
    rows = activity(spark, sf)
    quarter = F.concat(F.year("ts"), F.lit("Q"), F.quarter("ts"))
    years = rows.agg(F.year(F.min("ts")), F.year(F.max("ts"))).first()
    quarters = [f"{year}Q{q}" for year in range(years[0], years[1] + 1) for q in range(1, 5)]
    return churn_labels(rows.withColumn("month", quarter), quarters)


def _bound(which):
    def run(spark, sf):
        found = activity_bound(activity(spark, sf), which)
        return found.withColumn(f"{which}_date", F.date_format(f"{which}_date", STAMP))

    return run


for name, which in (("last", "max"), ("first", "min")):
    query(
        f"a1_{name}_activity",
        bound_sql(
            f"""SELECT bib_id, strftime({which}(ts), '{SQL_STAMP}') AS {which}_date
                FROM activity GROUP BY bib_id""",
            "package",
            "recharge",
            "activity",
        ),
    )(_bound(which))


@query(
    "j1_full_outer_last_activity",
    bound_sql(
        f"""SELECT bib_id, strftime(p, '{SQL_STAMP}') AS package_date,
                   strftime(r, '{SQL_STAMP}') AS recharge_date
            FROM (SELECT bib_id, max(activation_date) AS p FROM package GROUP BY bib_id)
            FULL JOIN (SELECT bib_id, max(recharge_dt) AS r FROM recharge GROUP BY bib_id)
            USING (bib_id)""",
        "package",
        "recharge",
    ),
)
def full_outer(spark, sf):
    tables = StarSchema(spark, sf)
    joined = combine_outer(
        {
            "package_date": activity_rows([(tables.package(), "activation_date")]),
            "recharge_date": activity_rows([(tables.recharge(), "recharge_dt")]),
        }
    )
    names = ("package_date", "recharge_date")
    return joined.select("bib_id", *(F.date_format(c, STAMP).alias(c) for c in names))


@query(
    "j2_current_with_next_activity",
    bound_sql(
        f"""SELECT bib_id, strftime(hi, '{SQL_STAMP}') AS max_date,
                   strftime(lo, '{SQL_STAMP}') AS min_date
            FROM (SELECT bib_id, max(ts) AS hi FROM activity
                  WHERE ts < TIMESTAMP '1998-01-01' GROUP BY bib_id)
            LEFT JOIN (SELECT bib_id, min(ts) AS lo FROM activity
                  WHERE ts >= TIMESTAMP '1998-01-01' GROUP BY bib_id) USING (bib_id)""",
        "package",
        "recharge",
        "activity",
    ),
)
def current_with_next(spark, sf):
    rows = activity(spark, sf)
    middle = F.lit("1998-01-01").cast("timestamp_ntz")
    last = activity_bound(rows.where(F.col("ts") < middle), "max")
    first = activity_bound(rows.where(F.col("ts") >= middle), "min")
    joined = last.join(first, "bib_id", "left")
    return joined.select(
        "bib_id", *(F.date_format(c, STAMP).alias(c) for c in ("max_date", "min_date"))
    )


@query(
    "j4_scoring_population",
    bound_sql(
        """SELECT bib_id, CAST(NULL AS INTEGER) AS label FROM package
           UNION SELECT bib_id, NULL FROM recharge""",
        "package",
        "recharge",
    ),
)
def population(spark, sf):
    tables = StarSchema(spark, sf)
    return scoring_population([tables.package(), tables.recharge()])


@query(
    "j5_recovered_rows_of_assigned_loans",
    bound_sql(
        """SELECT loan_id, bib_id, loan_amount, round(hsdp_recovery, 4) AS hsdp_recovery
           FROM loan_recovery WHERE loan_id IN (SELECT loan_id FROM loan_assign)""",
        "loan_assign",
        "loan_recovery",
    ),
)
def recovered(spark, sf):
    tables = StarSchema(spark, sf)
    rows = recovered_rows(tables.loan_assign(), tables.loan_recovery())
    return rows.select(
        "loan_id", "bib_id", "loan_amount", F.round("hsdp_recovery", 4).alias("hsdp_recovery")
    )


@query(
    "g1_common_loans",
    bound_sql(
        "SELECT loan_id FROM loan_assign INTERSECT SELECT loan_id FROM loan_recovery",
        "loan_assign",
        "loan_recovery",
    ),
)
def common_loans(spark, sf):
    tables = StarSchema(spark, sf)
    return common_values(tables.loan_assign(), tables.loan_recovery(), "loan_id")


@query(
    "a15_distinct_subscribers_with_loans",
    bound_sql("SELECT DISTINCT bib_id FROM loan_assign", "loan_assign"),
)
def distinct_borrowers(spark, sf):
    return StarSchema(spark, sf).loan_assign().select("bib_id").distinct()


@query("p8_constant_label", "SELECT CAST(c_custkey AS VARCHAR) AS bib_id, CAST(NULL AS INTEGER) AS label FROM customer")
def constant_label(spark, sf):
    users = StarSchema(spark, sf).raw("customer")
    return users.select(
        F.col("c_custkey").cast("string").alias("bib_id"), F.lit(None).cast("int").alias("label")
    )
