"""Exploratory aggregates and the data of each plot kind."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenura.catalog.columns import DURATION_SQL
from tenura.catalog.registry import bound_sql, query, rounded
from tenura.functions.columns import categorize_durations
from tenura.operators import explore
from tenura.sources.bindings import StarSchema


@query("a7_value_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def event_counts(spark, sf):
    return explore.value_counts(StarSchema(spark, sf).raw("events"), "event_type")


@query(
    "a8_loan_sum_per_person",
    bound_sql(
        "SELECT nid_hash, round(sum(loan_amount), 4) AS total FROM loan_assign GROUP BY nid_hash",
        "loan_assign",
    ),
)
def loans_per_person(spark, sf):
    totals = explore.sum_by(StarSchema(spark, sf).loan_assign(), "nid_hash", "loan_amount", "total")
    return totals.withColumn("total", F.round("total", 4))


def _profile_sql(table: str, ts: str, col: str) -> str:
    parts = {
        "hour": f"hour({ts})",
        "day_of_week": f"dayofweek({ts}) + 1",
        "day_of_month": f"day({ts})",
    }
    selects = [
        f"""SELECT '{part}' AS time_part, CAST({at} AS INTEGER) AS value,
                   round(sum({col}), 4) AS sum FROM {table} GROUP BY ALL"""
        for part, at in parts.items()
    ]
    return bound_sql(" UNION ALL ".join(selects), table)


@query(
    "a9_recharges_by_time", _profile_sql("recharge_timed", "recharge_dt", "recharge_value_amt")
)
def recharges_by_time(spark, sf):
    rows = StarSchema(spark, sf).recharge_timed()
    found = explore.time_profile(rows, "recharge_dt", "recharge_value_amt")
    return found.withColumn("sum", F.round("sum", 4))


@query("a9_loans_by_time", _profile_sql("loan_assign", "date_timestamp", "loan_amount"))
def loans_by_time(spark, sf):
    rows = StarSchema(spark, sf).loan_assign()
    found = explore.time_profile(rows, "date_timestamp", "loan_amount")
    return found.withColumn("sum", F.round("sum", 4))


SHARES_SQL = bound_sql(
    """SELECT gender_v, count(*) AS count,
              round(count(*) / sum(count(*)) OVER (), 6) AS share
       FROM subscriber WHERE gender_v IS NOT NULL GROUP BY gender_v""",
    "subscriber",
)


def shares(spark, sf):
    found = explore.category_shares(StarSchema(spark, sf).user(), "gender_v")
    return found.withColumn("share", F.round("share", 6))


query("a10_gender_counts", SHARES_SQL)(shares)
query("x7_pie_shares", SHARES_SQL)(shares)

PER_LOAN = """per_loan AS (
    SELECT loan_id, sum(loan_amount) AS sum_of_loan_amount, sum(hsdp_recovery) AS sum_of_recovery
    FROM loan_recovery WHERE loan_id IN (SELECT loan_id FROM loan_assign) GROUP BY loan_id)"""


@query(
    "a11_recovery_per_loan",
    bound_sql(
        """SELECT loan_id, round(sum_of_loan_amount, 4) AS sum_of_loan_amount,
                  round(sum_of_recovery, 4) AS sum_of_recovery FROM per_loan""",
        "loan_assign",
        "loan_recovery",
        more=PER_LOAN,
    ),
)
def per_loan(spark, sf):
    tables = StarSchema(spark, sf)
    found = explore.recovery_per_loan(tables.loan_assign(), tables.loan_recovery())
    return found.select("loan_id", *rounded("sum_of_loan_amount", "sum_of_recovery"))


def _ratio(assigned_from):
    def run(spark, sf):
        tables = StarSchema(spark, sf)
        found = explore.recovery_ratio(tables.loan_assign(), tables.loan_recovery(), assigned_from)
        return found.select(*rounded("recovered_sum", "assigned_sum", "recovered_percent", digits=2))

    return run


RATIO = """SELECT round(sum(sum_of_recovery), 2) AS recovered_sum,
                  round(sum({assigned}), 2) AS assigned_sum,
                  round(sum(sum_of_recovery) / sum({assigned}) * 100, 2) AS recovered_percent
           FROM per_loan"""
query(
    "a12_recovery_ratio",
    bound_sql(
        RATIO.format(assigned="sum_of_loan_amount"), "loan_assign", "loan_recovery", more=PER_LOAN
    ),
)(_ratio("recovery"))
query(
    "a12_recovery_ratio_of_assigned",
    bound_sql(
        RATIO.format(assigned="assigned")
        + """ JOIN (SELECT loan_id, sum(loan_amount) AS assigned FROM loan_assign GROUP BY loan_id)
              USING (loan_id)""",
        "loan_assign",
        "loan_recovery",
        more=PER_LOAN,
    ),
)(_ratio("assign"))


@query(
    "x8_recovery_bars",
    bound_sql(
        """SELECT 'RecoveredSum' AS bar, round(sum(sum_of_recovery), 2) AS amount FROM per_loan
           UNION ALL
           SELECT 'AssignedSum', round(sum(sum_of_loan_amount), 2) FROM per_loan""",
        "loan_assign",
        "loan_recovery",
        more=PER_LOAN,
    ),
)
def bars(spark, sf):
    tables = StarSchema(spark, sf)
    found = explore.recovery_bars(tables.loan_assign(), tables.loan_recovery())
    return found.withColumn("amount", F.round("amount", 2))


@query("a13_approximate_medians")
def approximate(spark, sf):
    orders = StarSchema(spark, sf).raw("lineitem")
    return explore.approximate_medians(orders, ["l_quantity", "l_extendedprice", "l_discount"])


MEDIAN_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "a13_approximate_median_ranks",
    "SELECT " + ", ".join(f"1 AS {c}" for c in MEDIAN_COLUMNS),
)
def approximate_ranks(spark, sf):
    """Whether each approximate median's rank is within the stated error of a half."""
    items = StarSchema(spark, sf).raw("lineitem")
    found = explore.approximate_medians(items, MEDIAN_COLUMNS, error=0.01).first()
    within = []
    for c in MEDIAN_COLUMNS:
        below = F.count_if(F.col(c) < found[c]) / F.count(c)
        upto = F.count_if(F.col(c) <= found[c]) / F.count(c)
        within.append(((below <= 0.51) & (upto >= 0.49)).cast("int").alias(c))
    return items.agg(*within)


@query(
    "a13_exact_medians",
    """SELECT quantile_disc(l_quantity, 0.5) AS l_quantity,
              quantile_disc(l_extendedprice, 0.5) AS l_extendedprice,
              quantile_disc(l_discount, 0.5) AS l_discount FROM lineitem""",
)
def exact(spark, sf):
    items = StarSchema(spark, sf).raw("lineitem")
    return explore.exact_medians(items, ["l_quantity", "l_extendedprice", "l_discount"])


@query(
    "a14_mode",
    bound_sql(
        """SELECT CAST(year(registration_date_d) AS INTEGER) AS registration_year FROM subscriber
           WHERE registration_date_d IS NOT NULL
           GROUP BY ALL ORDER BY count(*) DESC, registration_year LIMIT 1""",
        "subscriber",
    ),
)
def registration_mode(spark, sf):
    users = StarSchema(spark, sf).user()
    years = users.select(F.year("registration_date_d").alias("registration_year"))
    return explore.mode(years, "registration_year")


@query(
    "t1_sorted_counts",
    """SELECT o_orderpriority, count(*) AS count FROM orders
       GROUP BY o_orderpriority ORDER BY count DESC, o_orderpriority""",
)
def sorted_counts(spark, sf):
    counts = explore.value_counts(StarSchema(spark, sf).raw("orders"), "o_orderpriority")
    return counts.orderBy(F.desc("count"), "o_orderpriority")


@query(
    "t2_top_offerings",
    bound_sql(
        """SELECT offering_code, count(*) AS count FROM package GROUP BY offering_code
           ORDER BY count DESC, offering_code LIMIT 10""",
        "package",
    ),
)
def top_offerings(spark, sf):
    return explore.top_values(StarSchema(spark, sf).package(), "offering_code", 10)


@query(
    "t2_top_durations",
    bound_sql(
        f"""SELECT {DURATION_SQL} AS duration_category, count(*) AS count
            FROM (SELECT date_diff('day', CAST(activation_date AS DATE),
                                   CAST(deactivation_date AS DATE)) AS days FROM package)
            GROUP BY ALL ORDER BY count DESC, duration_category LIMIT 4""",
        "package",
    ),
)
def top_durations(spark, sf):
    labelled = categorize_durations(StarSchema(spark, sf).package())
    return explore.top_values(labelled, "duration_category", 4)


@query(
    "t3_first_row",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1",
)
def first_row(spark, sf):
    orders = StarSchema(spark, sf).raw("orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1)


@query(
    "t4_limit",
    "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10",
)
def limited(spark, sf):
    parts = StarSchema(spark, sf).raw("part").select("p_partkey", "p_retailprice")
    return parts.orderBy(F.desc("p_retailprice"), "p_partkey").limit(10)


@query(
    "s12_preview",
    bound_sql(
        """SELECT bib_id, loan_id, loan_amount FROM loan_assign ORDER BY loan_id LIMIT 20""",
        "loan_assign",
    ),
)
def preview(spark, sf):
    loans = StarSchema(spark, sf).loan_assign().select("bib_id", "loan_id", "loan_amount")
    return explore.preview(loans, 20, ["loan_id"])


@query(
    "x1_count_plot",
    """SELECT event_type, hour(ts)::INTEGER AS hour, count(*) AS count
       FROM events GROUP BY ALL""",
)
def count_plot(spark, sf):
    events = StarSchema(spark, sf).raw("events").withColumn("hour", F.hour("ts"))
    return explore.distribution(events, "count", "event_type", hue="hour")


@query(
    "x2_line_plot",
    """SELECT day, event_type, round(m, 6) AS mean, round(sd, 6) AS sd, n,
              round(m - 1.96 * sd / sqrt(n), 6) AS low, round(m + 1.96 * sd / sqrt(n), 6) AS high
       FROM (SELECT day(ts)::INTEGER AS day, event_type, avg(value) AS m,
                    stddev_samp(value) AS sd, count(value) AS n FROM events GROUP BY ALL)""",
)
def line_plot(spark, sf):
    events = StarSchema(spark, sf).raw("events").withColumn("day", F.dayofmonth("ts"))
    found = explore.distribution(events, "line", "day", "value", "event_type")
    names = ("mean", "sd", "low", "high")
    return found.withColumns({c: F.round(c, 6) for c in names})


BOX_SQL = """SELECT {hue} q1, median, q3, n, whisker_low, whisker_high, outliers FROM (
        SELECT {hue} round(any_value(a), 4) AS q1, round(any_value(b), 4) AS median,
               round(any_value(c), 4) AS q3, count(*) AS n,
               min(v) FILTER (v BETWEEN a - 1.5 * (c - a) AND c + 1.5 * (c - a)) AS whisker_low,
               max(v) FILTER (v BETWEEN a - 1.5 * (c - a) AND c + 1.5 * (c - a)) AS whisker_high,
               count(*) FILTER (v NOT BETWEEN a - 1.5 * (c - a) AND c + 1.5 * (c - a)) AS outliers
        FROM (SELECT {hue} {v} AS v, quantile_cont({v}, 0.25) OVER w AS a,
                     quantile_cont({v}, 0.5) OVER w AS b, quantile_cont({v}, 0.75) OVER w AS c
              FROM {table} WINDOW w AS ({partition}))
        GROUP BY ALL)"""


def _box(df, x, hue=None):
    found = explore.box(df, x, hue)
    return found.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query(
    "x3_box_plot",
    BOX_SQL.format(hue="", v="l_extendedprice", table="lineitem", partition=""),
)
def box_plot(spark, sf):
    return _box(StarSchema(spark, sf).raw("lineitem"), "l_extendedprice")


@query(
    "x3_box_plot_by_group",
    BOX_SQL.format(
        hue="event_type,", v="value", table="events", partition="PARTITION BY event_type"
    ),
)
def box_plot_by_group(spark, sf):
    return _box(StarSchema(spark, sf).raw("events"), "value", "event_type")


HIST_SQL = """SELECT {hue} bin, round(CASE WHEN bin >= 0 THEN CAST({low} + bin * {width} AS DOUBLE) END, 4) AS bin_low,
       round(CASE WHEN bin < {bins} THEN CAST({low} + (bin + 1) * {width} AS DOUBLE) END, 4) AS bin_high,
       count(*) AS count
    FROM (SELECT {hue} CAST(CASE WHEN {v} < {low} THEN -1 WHEN {v} > {high} THEN {bins}
                 ELSE least(floor(({v} - {low}) / ({high} - {low}) * {bins}), {bins} - 1) END AS BIGINT) AS bin
          FROM {table} WHERE {v} IS NOT NULL)
    GROUP BY ALL"""
# The counts of a histogram add up to the values.
HIST_SUM_SQL = "SELECT count({v}) AS n FROM {table}"


def _hist(df, x, bins, **more):
    found = explore.histogram(df, x, bins, **more)
    return found.withColumns({c: F.round(c, 4) for c in ("bin_low", "bin_high")})


@query(
    "x4_histogram",
    bound_sql(
        HIST_SQL.format(
            hue="", v="recharge_value_amt", low="0", high="500000", bins="25", width="20000",
            table="recharge",
        ),
        "recharge",
    ),
)
def histogram_plot(spark, sf):
    recharge = StarSchema(spark, sf).recharge()
    return _hist(recharge, "recharge_value_amt", 25, low=0.0, high=500000.0)


@query(
    "x4_histogram_by_group",
    HIST_SQL.format(
        hue="event_type,", v="value", low="0", high="400", bins="16", width="25", table="events",
    ),
)
def histogram_by_group(spark, sf):
    events = StarSchema(spark, sf).raw("events")
    return _hist(events, "value", 16, low=0.0, high=400.0, hue="event_type")


@query(
    "x4_histogram_auto",
    """WITH s AS (
        SELECT count(*) AS n, min(c_acctbal) AS lo, max(c_acctbal) AS hi,
               quantile_cont(c_acctbal, 0.75) - quantile_cont(c_acctbal, 0.25) AS iqr FROM customer),
    b AS (SELECT *, ceil((hi - lo) / least((hi - lo) / (log2(n) + 1),
                                           2 * iqr / power(n, 1.0 / 3))) AS bins FROM s)
    SELECT bin, round(lo + bin * (hi - lo) / bins, 4) AS bin_low,
           round(lo + (bin + 1) * (hi - lo) / bins, 4) AS bin_high, count(c_acctbal) AS count
    FROM (SELECT lo, hi, bins, unnest(range(bins::BIGINT)) AS bin FROM b)
    LEFT JOIN customer
      ON least(floor((c_acctbal - lo) / (hi - lo) * bins), bins - 1) = bin
    GROUP BY ALL""",
)
def histogram_auto(spark, sf):
    customers = StarSchema(spark, sf).raw("customer")
    found = explore.histogram(customers, "c_acctbal", empty=True)
    return found.withColumns({c: F.round(c, 4) for c in ("bin_low", "bin_high")})


@query(
    "x9_loan_sum_histogram",
    bound_sql(
        HIST_SQL.format(
            hue="", v="total", low="0", high="5000000", bins="20", width="250000", table="totals",
        ),
        "loan_assign",
        more="""totals AS (SELECT nid_hash, sum(loan_amount) AS total
                           FROM loan_assign GROUP BY nid_hash)""",
    ),
)
def loan_sum_histogram(spark, sf):
    loans = StarSchema(spark, sf).loan_assign()
    found = explore.person_loan_histogram(loans, 20, low=0.0, high=5000000.0)
    return found.withColumns({c: F.round(c, 4) for c in ("bin_low", "bin_high")})


@query("x4_histogram_sums", HIST_SUM_SQL.format(v="value", table="events"))
def histogram_sums(spark, sf):
    """Limits well inside the data: what lies beyond them is still counted."""
    found = explore.histogram(StarSchema(spark, sf).raw("events"), "value", 7, low=10.0, high=50.0)
    return found.agg(F.sum("count").alias("n"))


# The same binned kernel sum, each bin reaching every grid point.
KDE_SQL = """WITH g AS (
        SELECT {hue} count(*) AS n, min({v}) AS lo, max({v}) AS hi,
               stddev_samp({v}) * power(count(*), -0.2) AS bw
        FROM {table} GROUP BY ALL),
    s AS (SELECT *, lo - 3 * bw AS start, (hi - lo + 6 * bw) / {last} AS step,
                 sum(n) OVER () AS total FROM g),
    b AS (SELECT {hue} floor(({v} - lo) / bw * 16) AS bin, count(*) AS weight, avg({v}) AS mid
          FROM {table} JOIN s {using} GROUP BY ALL),
    d AS (
        SELECT {hue} point::INTEGER AS point, any_value(start + point * step) AS x,
               sum(weight * exp(-power((start + point * step - mid) / bw, 2) / 2))
                   / (sqrt(2 * pi()) * any_value(bw) * any_value(total)) AS density
        FROM b JOIN s {using} CROSS JOIN (SELECT unnest(range({last} + 1)) AS point)
        GROUP BY ALL)"""


@query(
    "x5_density",
    KDE_SQL.format(hue="", v="o_totalprice", table="orders", last="199", using="ON true")
    + "SELECT point, round(x, 2) AS x, round(density * 1e6, 4) AS density FROM d",
)
def density(spark, sf):
    found = explore.kde(StarSchema(spark, sf).raw("orders"), "o_totalprice")
    return found.select(
        "point", F.round("x", 2).alias("x"), F.round(F.col("density") * 1e6, 4).alias("density")
    )


@query(
    "x5_density_by_group",
    KDE_SQL.format(
        hue="event_type,", v="value", table="events", last="199", using="USING (event_type)"
    )
    + "SELECT event_type, point, round(x, 4) AS x, round(density, 8) AS density FROM d",
)
def density_by_group(spark, sf):
    found = explore.distribution(StarSchema(spark, sf).raw("events"), "kde", "value", hue="event_type")
    return found.select(
        "event_type", "point", F.round("x", 4).alias("x"), F.round("density", 8).alias("density")
    )


@query(
    "x6_violin",
    KDE_SQL.format(
        hue="event_type,", v="value", table="events", last="199", using="USING (event_type)"
    )
    + "SELECT event_type, point, round(x, 4) AS x, round(density, 8) AS density, * EXCLUDE "
    + "(event_type, point, x, density) FROM d JOIN ("
    + BOX_SQL.format(
        hue="event_type,", v="value", table="events", partition="PARTITION BY event_type"
    )
    + ") USING (event_type)",
)
def violin_plot(spark, sf):
    found = explore.distribution(StarSchema(spark, sf).raw("events"), "violin", "value", hue="event_type")
    digits = {"x": 4, "density": 8, "q1": 4, "median": 4, "q3": 4}
    return found.withColumns({c: F.round(c, d) for c, d in digits.items()})
