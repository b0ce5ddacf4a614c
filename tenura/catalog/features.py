"""Per-subscriber features and modelling datasets."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.catalog.registry import bound_sql, query, rounded
from tenura.operators.dataset import Source, labelled_dataset, population_dataset
from tenura.operators.features import (
    FEATURE_SETS,
    aggregate_features,
    subscriber_features,
    user_attributes,
    with_duration,
)
from tenura.schemas import AMOUNT_FEATURES, USAGE_FEATURES
from tenura.sources.bindings import (
    AS_OF,
    CURRENT_START,
    NEXT_END,
    PERIOD_COLUMN,
    StarSchema,
)

ROUNDED = [c for c in AMOUNT_FEATURES if c.startswith("Median")] + [
    "SumCallDuration",
    "SumGPRSUsage",
    "age",
]


def tidy(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ROUNDED if c in df.columns})


# One aggregate per table; {where} limits it to a period, {keys} may add one.
AGGREGATES = {
    "loan_assign": """SELECT {keys}, count(*) AS "CountAssignLoanAmount",
        round(median(loan_amount), 4) AS "MedianAssignLoanAmount"
        FROM loan_assign {where} GROUP BY ALL""",
    "loan_recovery": """SELECT {keys}, count(*) AS "CountRecoveryLoanAmount",
        round(median(loan_amount), 4) AS "MedianRecoveryLoanAmount"
        FROM loan_recovery {where} GROUP BY ALL""",
    "package": """SELECT {keys}, count(*) AS "CountPackage",
        round(median(offer_amount), 4) AS "MedianPackageAmount",
        round(median(date_diff('day', CAST(activation_date AS DATE),
                               CAST(deactivation_date AS DATE))), 4) AS "MedianPackageDuration"
        FROM package {where} GROUP BY ALL""",
    "recharge": """SELECT {keys}, count(*) AS "CountRecharge",
        round(median(recharge_value_amt), 4) AS "MedianRechargeAmount"
        FROM recharge {where} GROUP BY ALL""",
    "cdr": """SELECT {keys}, CAST(sum(sms_count) AS BIGINT) AS "SumSMSCount",
        CAST(sum(voice_count) AS BIGINT) AS "SumVoiceCount",
        round(sum(call_duration), 4) AS "SumCallDuration",
        round(sum(gprs_usage), 4) AS "SumGPRSUsage"
        FROM cdr GROUP BY ALL""",
}
USER_SQL = """SELECT bib_id,
    round(date_diff('day', date_of_birth_d, DATE '2024-01-01') / 365.25, {digits}) AS age,
    CAST(year(registration_date_d) AS INTEGER) AS registration_year,
    contract_type_v, gender_v, ability_status, account_balance
    FROM subscriber"""
EXACT_USER_SQL = USER_SQL.format(digits=15)
USER_SQL = USER_SQL.format(digits=4)


def aggregate_sql(table: str, where: str = "", keys: str = "bib_id") -> str:
    return AGGREGATES[table].format(keys=keys, where=where)


def _period(table: str) -> str:
    column = PERIOD_COLUMN[table]
    return f"WHERE {column} >= TIMESTAMP '1996-01-01' AND {column} < TIMESTAMP '1996-04-01'"


def dataset_sql(population: str, aggregates: dict[str, str], users: str = USER_SQL) -> str:
    """The star of left joins over a population, activity features filled with 0."""
    filled = [f'coalesce("{c}", 0) AS "{c}"' for c in AMOUNT_FEATURES + USAGE_FEATURES]
    joins = "".join(f" LEFT JOIN ({sql}) USING (bib_id)" for sql in aggregates.values())
    return f"""SELECT bib_id, label, {', '.join(filled)}, age, registration_year,
        contract_type_v, gender_v, ability_status, account_balance
        FROM {population}{joins} LEFT JOIN ({users}) USING (bib_id)"""


PERIOD_AGGREGATES = {
    t: aggregate_sql(t, _period(t) if t in PERIOD_COLUMN else "") for t in AGGREGATES
}
ALL_TABLES = ("loan_assign", "loan_recovery", "package", "recharge", "cdr", "subscriber")
DATASET_SQL = bound_sql(
    dataset_sql("label", PERIOD_AGGREGATES), *ALL_TABLES, "activity", "label"
)


def quarter_sources(
    star: StarSchema, first: datetime.datetime, end: datetime.datetime, names: list[str]
) -> list[Source]:
    """Rows in [first, end) with their quarter's name; undated ones repeat for each."""
    found = []
    for df, kinds, at in star.sources():
        if at is None:
            found.append((df.select("*", F.explode(F.array(*map(F.lit, names))).alias("split")), kinds))
            continue
        split = F
        for number, name in enumerate(names, start=(first.month + 2) // 3):
            split = split.when(F.quarter(at) == number, F.lit(name))
        inside = df.where((F.col(at) >= F.lit(first)) & (F.col(at) < F.lit(end)))
        found.append((inside.withColumn("split", split), kinds))
    return found


def dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The first quarter of 1996, labelled by the second, in one pass."""
    names = ["current", "next"]
    sources = quarter_sources(StarSchema(spark, sf), CURRENT_START, NEXT_END, names)
    return labelled_dataset(sources, names, AS_OF, "split", ["current"]).drop("split")


def _aggregate(table):
    def run(spark, sf):
        df = getattr(StarSchema(spark, sf), table)()
        if table == "package":
            df = with_duration(df)
        return tidy(aggregate_features(df, FEATURE_SETS[table]))

    return run


for number, table in enumerate(AGGREGATES, start=2):
    names = {"loan_assign": "loans", "loan_recovery": "recoveries", "package": "packages",
             "recharge": "recharges", "cdr": "usage"}
    query(f"a{number}_{names[table]}", bound_sql(aggregate_sql(table), table))(_aggregate(table))


@query("m12_user_attributes", bound_sql(USER_SQL, "subscriber"))
def users(spark, sf):
    return tidy(user_attributes(StarSchema(spark, sf).user(), AS_OF))


@query(
    "m13_feature_bundle",
    bound_sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS source, count(*) AS subscribers FROM ({sql})"
            for t, sql in {
                **{t: aggregate_sql(t) for t in AGGREGATES}, "user": USER_SQL
            }.items()
        ),
        *ALL_TABLES,
    ),
)
def bundle(spark, sf):
    found = subscriber_features(StarSchema(spark, sf).tables(), AS_OF)
    counts = [
        df.agg(F.count(F.lit(1)).alias("subscribers")).select(
            F.lit(name).alias("source"), "subscribers"
        )
        for name, df in found.items()
    ]
    merged = counts[0]
    for df in counts[1:]:
        merged = merged.unionByName(df)
    return merged


@query(
    "j3_joined_features",
    bound_sql(
        dataset_sql("population", {t: aggregate_sql(t) for t in AGGREGATES}),
        *ALL_TABLES,
        more="""population AS (
            SELECT bib_id, CAST(NULL AS INTEGER) AS label FROM package
            UNION SELECT bib_id, NULL FROM recharge)""",
    ),
)
def joined(spark, sf):
    sources = [(df, kinds) for df, kinds, _ in StarSchema(spark, sf).sources()]
    return tidy(population_dataset(sources, None, AS_OF))


@query("l4_modelling_dataset", DATASET_SQL)
def labelled(spark, sf):
    return tidy(dataset(spark, sf))


# Quarters by split: the first two are labelled by their following quarter.
SPLITS = {"1996Q1": "train", "1996Q2": "eval", "1996Q3": "test"}


def split_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Train, eval and unlabelled test rows in one pass over the tables."""
    names = list(SPLITS.values())
    end = datetime.datetime(1996, 10, 1)
    sources = quarter_sources(StarSchema(spark, sf), CURRENT_START, end, names)
    return labelled_dataset(sources, names, AS_OF, "split")


def split_sql(users: str = USER_SQL) -> str:
    parts = []
    for i, split in enumerate(SPLITS.values()):
        start, middle, end = (f"TIMESTAMP '1996-{m:02d}-01'" for m in (3 * i + 1, 3 * i + 4, 3 * i + 7))

        def inside(column, low=start, high=middle):
            return f"WHERE {column} >= {low} AND {column} < {high}"

        if split == "test":
            population = f"""SELECT DISTINCT bib_id, CAST(NULL AS INTEGER) AS label
                FROM activity {inside('ts')}"""
        else:
            population = f"""SELECT bib_id, CASE WHEN lo IS NULL OR
                    date_diff('day', CAST(hi AS DATE), CAST(lo AS DATE)) > 30
                    THEN 1 ELSE 0 END AS label
                FROM (SELECT bib_id, max(ts) AS hi FROM activity {inside('ts')} GROUP BY bib_id)
                LEFT JOIN (SELECT bib_id, min(ts) AS lo FROM activity
                           {inside('ts', middle, end)} GROUP BY bib_id) USING (bib_id)"""
        aggregates = {
            t: aggregate_sql(t, inside(PERIOD_COLUMN[t]) if t in PERIOD_COLUMN else "")
            for t in AGGREGATES
        }
        parts.append(
            f"SELECT '{split}' AS split, * FROM ({dataset_sql(f'({population})', aggregates, users)})"
        )
    return " UNION ALL ".join(parts)


@query("l5_datasets_of_all_splits", bound_sql(split_sql(), *ALL_TABLES, "activity"))
def all_splits(spark, sf):
    return tidy(split_dataset(spark, sf))
