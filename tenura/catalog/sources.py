"""Files: CSV landing, Parquet tables and month partitions."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.catalog.registry import bound_sql, query
from tenura.operators.activity import (
    activity_bounds_of_summaries,
    churn_label,
    churn_labels_of_summaries,
    package_recharge_activity,
)
from tenura.schemas import (
    DATE_COLUMNS,
    TABLES,
    TIMESTAMP_COLUMNS,
    conform,
    loaded_schema,
    raw_schema,
)
from tenura.sources.bindings import PERIOD_COLUMN, StarSchema
from tenura.sources.bucketed import read_activity, write_activity
from tenura.sources.csv import read_landing_table
from tenura.sources.lake import MONTH, Lake, ingest, load_activity, load_months, load_rejects
from tenura.sources.parquet import read_table, write_table
from tenura.sources.published import publish, read_partitions
from tenura.sources.shared import new_path

ALL = "all"
# Tables that are written at the same time: the last tasks of one leave cores to the next.
TOGETHER = 3


def landing_text(df: DataFrame, table: str) -> DataFrame:
    """A bound table as it would be delivered: declared columns, dates as text."""
    text = {
        c: F.date_format(c, "yyyyMMdd HH:mm:ss")
        for c in TIMESTAMP_COLUMNS[table]
        if c in df.columns
    }
    text |= {c: F.date_format(c, "yyyyMMdd") for c in DATE_COLUMNS[table] if c in df.columns}
    return conform(df.withColumns(text), raw_schema(table))


def with_month(df: DataFrame, table: str, month=F.year) -> DataFrame:
    """Add the period a row belongs to; undated tables have a single one."""
    if table not in PERIOD_COLUMN:
        return df.withColumn(MONTH, F.lit(ALL))
    return df.withColumn(MONTH, month(PERIOD_COLUMN[table]).cast("string"))


def months_of(table: str, df: DataFrame) -> list[str]:
    """The years of a table's rows, or the single period of an undated one."""
    if table not in PERIOD_COLUMN:
        return [ALL]
    at = PERIOD_COLUMN[table]
    first, last = df.agg(F.year(F.min(at)), F.year(F.max(at))).first()
    return [] if first is None else [str(year) for year in range(first, last + 1)]


def build_lake(spark: SparkSession, sf: str, tables=TABLES, month=F.year) -> Lake:
    """Bound tables written as monthly partitions, several at a time."""
    lake = Lake(new_path(spark, "lake"))

    def write(bound: tuple[str, DataFrame]) -> None:
        table, df = bound
        rows = conform(with_month(df, table, month), loaded_schema(table).add(MONTH, "string"))
        write_table(rows, lake.table_path(table), partition_by=[MONTH], rebalance=True)

    with ThreadPoolExecutor(TOGETHER) as pool:
        list(pool.map(inheritable_thread_target(write), StarSchema(spark, sf).tables(tables).items()))
    return lake


@query(
    "s1_csv_scan",
    bound_sql(
        """SELECT bib_id, recharge_value_amt,
                  strftime(recharge_dt, '%Y-%m-%d %H:%M:%S') AS recharge_dt,
                  CAST(NULL AS VARCHAR) AS origin_host_nm
           FROM recharge""",
        "recharge",
    ),
)
def csv_scan(spark, sf):
    """CSV whose header order differs from the declared one."""
    path = new_path(spark, "recharge-csv")
    text = landing_text(StarSchema(spark, sf).recharge(), "recharge")
    text.select(text.columns[::-1]).write.csv(path, header=True)
    return read_landing_table(spark, "recharge", path).select(
        "bib_id",
        "recharge_value_amt",
        F.date_format("recharge_dt", "yyyy-MM-dd HH:mm:ss").alias("recharge_dt"),
        "origin_host_nm",
    )


COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS source, count(*) AS n_rows, count(DISTINCT bib_id) AS subscribers FROM {b}"
    for t, b in zip(TABLES, [*TABLES[:-1], "subscriber"])
)


def _counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and subscribers per table; the distinct keys are combined before counting."""
    found = None
    for name, df in tables.items():
        per_key = df.groupBy("bib_id").agg(F.count(F.lit(1)).alias("n"))
        counts = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("bib_id").alias("subscribers")
        ).select(F.lit(name).alias("source"), "n_rows", "subscribers")
        found = counts if found is None else found.unionByName(counts)
    return found


@query("s2_declared_tables", bound_sql(COUNTS_SQL, *TABLES[:-1], "subscriber"))
def declared(spark, sf):
    """All six tables in their declared columns and types."""
    bound = StarSchema(spark, sf).tables()
    return _counts({t: conform(df, loaded_schema(t)) for t, df in bound.items()})


@query(
    "s3_parquet_scan",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'""",
)
def parquet_scan(spark, sf):
    items = read_table(spark, f"{sf}/lineitem.parquet")
    at = F.col("l_shipdate")
    inside = (at >= F.lit("1996-01-01").cast("timestamp_ntz")) & (
        at < F.lit("1997-01-01").cast("timestamp_ntz")
    )
    return items.where(inside).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "s4_parquet_sink",
    """SELECT o_orderstatus, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total FROM orders
       WHERE o_orderstatus <> 'F' OR o_totalprice > 250000 GROUP BY o_orderstatus""",
)
def parquet_sink(spark, sf):
    """A partitioned table whose F partition is replaced by a second write."""
    path = new_path(spark, "orders")
    orders = StarSchema(spark, sf).raw("orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus"
    )
    write_table(orders, path, partition_by=["o_orderstatus"])
    large = orders.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 250000))
    write_table(large, path, partition_by=["o_orderstatus"])
    return read_table(spark, path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "s5_csv_to_parquet",
    bound_sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS source, CAST(year({c}) AS VARCHAR) AS month, count(*) AS n_rows "
            f"FROM {t} GROUP BY ALL"
            for t, c in PERIOD_COLUMN.items()
        )
        + " UNION ALL SELECT 'cdr', 'all', count(*) FROM cdr"
        + " UNION ALL SELECT 'user', 'all', count(*) FROM subscriber",
        *TABLES[:-1],
        "subscriber",
    ),
)
def csv_to_parquet(spark, sf):
    """All six tables landed as CSV per period, ingested, and read back."""
    root = new_path(spark, "lake")
    lake = Lake(root, landing="{root}/landing/{table}/month={month}")
    found = None
    for table, df in StarSchema(spark, sf).tables().items():
        months = months_of(table, df)
        text = landing_text(df, table)
        if table in PERIOD_COLUMN:
            text = text.withColumn(MONTH, F.substring(PERIOD_COLUMN[table], 1, 4))
        else:
            text = text.withColumn(MONTH, F.lit(ALL))
        landing = lake.csv_path(table, "").removesuffix("/month=")
        text = text.hint("rebalance", MONTH)
        text.write.partitionBy(MONTH).csv(landing, header=True, compression="gzip")
        ingest(spark, lake, months, [table])
        loaded = load_months(spark, lake, months, [table])[table]
        counts = loaded.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n_rows"))
        counts = counts.select(F.lit(table).alias("source"), MONTH, "n_rows")
        found = counts if found is None else found.unionByName(counts)
    return found


@query(
    "s4_s5_month_that_becomes_empty",
    bound_sql(
        """SELECT CAST(year(recharge_dt) AS VARCHAR) AS month, count(*) AS n_rows FROM recharge
           WHERE year(recharge_dt) <> 1996 GROUP BY ALL
           UNION ALL SELECT '1996', 0""",
        "recharge",
    ),
)
def emptied_month(spark, sf):
    """Ingested, then ingested anew for one year whose file has no rows any more."""
    lake = Lake(new_path(spark, "lake"), landing="{root}/landing/{table}/{month}")
    recharge = StarSchema(spark, sf).recharge()
    text = landing_text(recharge, "recharge").withColumn(MONTH, F.substring("recharge_dt", 1, 4))
    months = months_of("recharge", recharge)
    for month in months:
        rows = text.where(F.col(MONTH) == month).drop(MONTH)
        rows.write.csv(lake.csv_path("recharge", month), header=True)
    ingest(spark, lake, months, ["recharge"])
    nothing = text.where("false").drop(MONTH).coalesce(1)
    nothing.write.mode("overwrite").csv(lake.csv_path("recharge", "1996"), header=True)
    ingest(spark, lake, ["1996"], ["recharge"])
    loaded = load_months(spark, lake, months, ["recharge"])["recharge"]
    counts = loaded.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n_rows"))
    named = spark.createDataFrame([(m,) for m in months], f"{MONTH} string")
    return named.join(counts, MONTH, "left").select(
        MONTH, F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


@query(
    "s4_s5_failed_and_unmoved_writes",
    bound_sql(
        """SELECT CAST(year(recharge_dt) AS VARCHAR) AS month, count(*) AS n_rows,
                  CAST(round(sum(round(recharge_value_amt * 100))) AS BIGINT) AS cents
           FROM recharge
           WHERE year(recharge_dt) <> 1997 OR recharge_value_amt > 200000 GROUP BY ALL""",
        "recharge",
    ),
)
def failed_write(spark, sf):
    """A write of two years that fails half-way leaves both; one left unmoved is current.

    1996 and 1997 are written with a row that can't be computed, then 1997 anew with its
    large amounts, published but not moved to its plain folder.
    """
    path = new_path(spark, "published")
    recharge = StarSchema(spark, sf).recharge()
    rows = recharge.withColumn(MONTH, F.year("recharge_dt").cast("string"))
    publish(rows, path, MONTH, months_of("recharge", recharge), rebalance=True)
    two = rows.where(F.col(MONTH).isin("1996", "1997"))
    last = two.agg(F.max("recharge_dt")).first()[0]
    broken = F.when(F.col("recharge_dt") == F.lit(last), F.raise_error(F.lit("broken row")))
    try:
        publish(two.withColumn("bib_id", F.coalesce(broken, "bib_id")), path, MONTH)
        raise AssertionError("the write should have failed")
    except SparkRuntimeException:
        pass
    large = two.where((F.col(MONTH) == "1997") & (F.col("recharge_value_amt") > 200000))
    publish(large, path, MONTH, ["1997"], settle=False)
    cents = F.round(F.sum(F.round(F.col("recharge_value_amt") * 100))).cast("long")
    return read_partitions(spark, path, MONTH).groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("n_rows"), cents.alias("cents")
    )


@query(
    "s1_p1_rejected_cells",
    bound_sql(
        """SELECT CAST(year(recharge_dt) AS VARCHAR) AS month, 'recharge' AS source,
                  'recharge_value_amt' AS column_name, count(*) AS n, min('n/a ' || bib_id) AS least,
                  max('n/a ' || bib_id) AS largest
           FROM recharge WHERE CAST(bib_id AS BIGINT) % 7 = 0 GROUP BY ALL
           UNION ALL
           SELECT CAST(year(recharge_dt) AS VARCHAR), 'recharge', 'recharge_dt', count(*),
                  min(strftime(recharge_dt, '%Y%m%d %H:%M:%S') || '?'),
                  max(strftime(recharge_dt, '%Y%m%d %H:%M:%S') || '?')
           FROM recharge WHERE CAST(bib_id AS BIGINT) % 5 = 0 GROUP BY ALL
           UNION ALL
           SELECT CAST(year(recharge_dt) AS VARCHAR), 'loaded', 'nulls', count(*), NULL, NULL
           FROM recharge WHERE CAST(bib_id AS BIGINT) % 7 = 0 OR CAST(bib_id AS BIGINT) % 5 = 0
           GROUP BY ALL""",
        "recharge",
    ),
)
def rejected(spark, sf):
    """Planted unreadable amounts and times: what is rejected, and the rows loaded with nulls."""
    lake = Lake(new_path(spark, "lake"), landing="{root}/landing/{table}/month={month}")
    recharge = StarSchema(spark, sf).recharge()
    months = months_of("recharge", recharge)
    key = F.col("bib_id").cast("long")
    amount, at = F.col("recharge_value_amt").cast("string"), F.col("recharge_dt")
    text = landing_text(recharge, "recharge").withColumns(
        {
            MONTH: F.substring("recharge_dt", 1, 4),
            "recharge_value_amt": F.when(key % 7 == 0, F.concat(F.lit("n/a "), "bib_id")).otherwise(amount),
            "recharge_dt": F.when(key % 5 == 0, F.concat(at, F.lit("?"))).otherwise(at),
        }
    )
    landing = lake.csv_path("recharge", "").removesuffix("/month=")
    text.hint("rebalance", MONTH).write.partitionBy(MONTH).csv(landing, header=True)
    ingest(spark, lake, months, ["recharge"], rejects=True)
    cells = load_rejects(spark, lake, months, ["recharge"]).groupBy(
        MONTH, "source", F.col("column").alias("column_name")
    )
    found = cells.agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("least"), F.max("text").alias("largest"))
    loaded = load_months(spark, lake, months, ["recharge"])["recharge"]
    holes = loaded.where(F.col("recharge_value_amt").isNull() | F.col("recharge_dt").isNull())
    none = F.lit(None).cast("string")
    return found.unionByName(
        holes.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n")).select(
            MONTH, F.lit("loaded").alias("source"), F.lit("nulls").alias("column_name"), "n",
            none.alias("least"), none.alias("largest"),
        )
    )


@query(
    "s6_tables_of_one_month",
    bound_sql(
        COUNTS_SQL,
        *TABLES[:-1],
        "subscriber",
        more=", ".join(
            f"{t}_96 AS (SELECT * FROM {t} WHERE year({c}) = 1996)"
            for t, c in PERIOD_COLUMN.items()
        ),
    )
    .replace("FROM loan_assign UNION", "FROM loan_assign_96 UNION")
    .replace("FROM loan_recovery UNION", "FROM loan_recovery_96 UNION")
    .replace("FROM package UNION", "FROM package_96 UNION")
    .replace("FROM recharge UNION", "FROM recharge_96 UNION"),
)
def one_month(spark, sf):
    lake = build_lake(spark, sf)
    dated = load_months(spark, lake, ["1996"], list(PERIOD_COLUMN))
    undated = load_months(spark, lake, [ALL], ["cdr", "user"])
    return _counts(dated | undated)


@query(
    "s7_activity_of_two_months",
    bound_sql(
        """SELECT bib_id, CASE WHEN lo IS NULL OR
                  date_diff('day', CAST(hi AS DATE), CAST(lo AS DATE)) > 30 THEN 1 ELSE 0
                  END AS label
           FROM (SELECT bib_id, max(ts) AS hi FROM activity WHERE year(ts) = 1996 GROUP BY bib_id)
           LEFT JOIN (SELECT bib_id, min(ts) AS lo FROM activity WHERE year(ts) = 1997
                      GROUP BY bib_id) USING (bib_id)""",
        "package",
        "recharge",
        "activity",
    ),
)
def two_months(spark, sf):
    lake = build_lake(spark, sf, ["package", "recharge"])
    tables = load_activity(spark, lake, ["1996", "1997"])
    rows = package_recharge_activity(tables["package"], tables["recharge"], (MONTH, "bib_id"))
    by_month = [rows.where(F.col(MONTH) == m).drop(MONTH) for m in ("1996", "1997")]
    return churn_label(*by_month)


# Buckets of the queries' tables; a large lake takes as many as give about 200 MB each.
QUERY_BUCKETS = 8
YEARLY_SQL = """yearly AS (SELECT bib_id, year(ts) AS y, min(ts) AS lo, max(ts) AS hi, count(*) AS n
                FROM activity GROUP BY ALL)"""


def _bucketed_years(spark, sf) -> tuple[DataFrame, list[str]]:
    """Activity by year in a bucketed table; the middle year is written twice."""
    tables = StarSchema(spark, sf).tables(["package", "recharge"])
    by_year = {t: with_month(df, t) for t, df in tables.items()}
    activity = package_recharge_activity(*by_year.values(), (MONTH, "bib_id"))
    years = sorted({y for t, df in tables.items() for y in months_of(t, df)})
    path = new_path(spark, "activity")
    write_activity(activity, path, years, QUERY_BUCKETS)
    again = years[len(years) // 2]
    write_activity(activity.where(F.col(MONTH) == again), path, [again], QUERY_BUCKETS)
    return read_activity(spark, path, years, QUERY_BUCKETS), years


@query(
    "l3_labels_of_bucketed_months",
    bound_sql(
        """SELECT CAST(a.y AS VARCHAR) AS month, a.bib_id, CASE WHEN b.lo IS NULL OR
                  date_diff('day', CAST(a.hi AS DATE), CAST(b.lo AS DATE)) > 30 THEN 1 ELSE 0
                  END AS label
           FROM yearly AS a LEFT JOIN yearly AS b ON a.bib_id = b.bib_id AND b.y = a.y + 1
           WHERE a.y < (SELECT max(y) FROM yearly)""",
        "package",
        "recharge",
        "activity",
        more=YEARLY_SQL,
    ),
)
def bucketed_labels(spark, sf):
    """Labels of all years in one pass over a bucketed table, without an exchange."""
    return churn_labels_of_summaries(*_bucketed_years(spark, sf))


@query(
    "a1_activity_bounds_of_bucketed_months",
    bound_sql(
        """SELECT bib_id, strftime(min(lo), '%Y-%m-%d') AS first_day,
                  strftime(max(hi), '%Y-%m-%d') AS last_day, CAST(sum(n) AS BIGINT) AS n_rows
           FROM yearly GROUP BY bib_id""",
        "package",
        "recharge",
        "activity",
        more=YEARLY_SQL,
    ),
)
def bucketed_bounds(spark, sf):
    bounds = activity_bounds_of_summaries(_bucketed_years(spark, sf)[0])
    return bounds.select(
        "bib_id",
        F.date_format("min_date", "yyyy-MM-dd").alias("first_day"),
        F.date_format("max_date", "yyyy-MM-dd").alias("last_day"),
        "n_rows",
    )
