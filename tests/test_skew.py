import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.operators import skew
from tenura.operators.explore import recovered_rows
from tenura.operators.skew import (
    HotGroups,
    Quantile,
    count_hot_groups,
    grouped_quantiles,
    join_small,
)

WANTED = {
    "median": Quantile("a"),
    "low": Quantile("a", 0.25, False),
    "high": Quantile("a", 0.9),
    "least": Quantile("a", 0.0),
    "most": Quantile("a", 1.0, False),
    "whole": Quantile("b"),
    "empty": Quantile("c"),
}
def counted():
    return {"n": F.count(F.lit(1)), "total": F.sum("b")}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a seventh under null."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 7 == 1, None).otherwise((i % 50).cast("string"))
    return spark.range(12000).select(
        key.alias("k"),
        F.when(i % 11 != 0, F.round(F.rand(1) * 1000, 2)).alias("a"),
        F.when(i % 5 != 0, (i % 97).cast("int")).alias("b"),
        F.lit(None).cast("double").alias("c"),
    ).repartition(5, "a").cache()


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("accuracy", [50_000, 40])
def test_hot_groups_give_the_same_quantiles(skewed, monkeypatch, accuracy):
    monkeypatch.setattr(skew, "SKETCH_ACCURACY", accuracy)
    plain = collected(grouped_quantiles(skewed, ["k"], WANTED, counted()))
    assert collected(grouped_quantiles(skewed, ["k"], WANTED, counted(), hot_rows=500)) == plain
    assert len(plain) == 52


def test_salted_join_gives_the_same_quantiles(skewed, monkeypatch):
    plain = collected(grouped_quantiles(skewed, ["k"], WANTED, counted()))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(skew, "SALTS", 3)
    assert collected(grouped_quantiles(skewed, ["k"], WANTED, counted(), hot_rows=500)) == plain


def test_whole_table_quantiles_match_numpy(skewed):
    values = np.array([r[0] for r in skewed.select("a").where("a is not null").collect()])
    for hot_rows in (10, 10**9):
        row = grouped_quantiles(skewed, [], WANTED, hot_rows=hot_rows).first()
        assert row["median"] == pytest.approx(np.quantile(values, 0.5), abs=1e-9)
        assert row["high"] == pytest.approx(np.quantile(values, 0.9), abs=1e-9)
        assert row["low"] == np.quantile(values, 0.25, method="inverted_cdf")
        assert (row["least"], row["most"], row["empty"]) == (values.min(), values.max(), None)


def test_repeated_values_and_few_rows(rows):
    rng = random.Random(5)
    for values in ([1.0], [1.0, 2.0], [3.0] * 40, [1.0, 1.0, 1.0, 2.0, 9.0], [None, 4.0],
                   [float(rng.randrange(4)) for _ in range(101)]):
        df = rows("a double", [(v,) for v in values])
        wanted = {f"q{int(p * 100)}{kind}": Quantile("a", p, kind)
                  for p in (0, 0.25, 0.5, 0.75, 1) for kind in (True, False)}
        plain = grouped_quantiles(df, [], wanted).first()
        assert grouped_quantiles(df, [], wanted, hot_rows=0).first() == plain


def test_observed_quantiles_are_values_of_the_data(rows):
    df = rows("a double", [(v,) for v in (1.0, 2.0, 3.0, 4.0)])
    wanted = {n: Quantile("a", p, False) for n, p in (("x", 0.25), ("y", 0.5), ("z", 0.75))}
    assert tuple(grouped_quantiles(df, [], wanted).first()) == (1.0, 2.0, 3.0)


def test_hot_groups_are_found_per_table(skewed, rows):
    found = count_hot_groups({"big": skewed, "small": rows("k string", [("a",)])}, ["k"], 1000)
    assert found["big"].count == 2 and found["small"] == HotGroups(None, 0)
    assert {r["k"] for r in found["big"].rows.collect()} == {"hot", None}


@pytest.mark.parametrize("limit", [0, 1000])
def test_join_small_matches_null_keys(skewed, rows, monkeypatch, limit):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
    small = rows("k string, x int", [("hot", 1), (None, 2)])
    joined = join_small(skewed, small, ["k"])
    assert joined.columns == ["k", "a", "b", "c", "x"]
    expected = {r["k"]: r["n"] for r in skewed.groupBy("k").agg(F.count("*").alias("n")).collect()}
    found = dict(joined.groupBy("x").count().collect())
    assert found == {1: expected["hot"], 2: expected[None]}
    rest = join_small(skewed, small, ["k"], "left_anti")
    assert rest.count() == 12000 - sum(found.values())


def test_join_small_broadcasts_only_short_tables(skewed, rows, monkeypatch):
    small = rows("k string, x int", [("hot", 1), ("1", 2)])

    def plan(df):
        return df._jdf.queryExecution().toString()

    assert "strategy=broadcast" in plan(join_small(skewed, small, ["k"]))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 1)
    assert "strategy=broadcast" not in plan(join_small(skewed, small, ["k"]))


def test_semi_join_is_split_where_a_key_is_hot(spark):
    """Without a distinct on either side, adaptive execution splits the skewed partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        i = F.col("id")
        recovery = spark.range(0, 300_000, 1, 8).select(
            F.when(i % 3 > 0, "hot").otherwise(i.cast("string")).alias("loan_id"), F.rand(1).alias("x")
        )
        assign = spark.range(0, 1000, 1, 4).select(
            F.when(i == 1, "hot").otherwise(i.cast("string")).alias("loan_id")
        )
        found = recovered_rows(assign, recovery)
        assert len(found.collect()) == 200_000 + 334
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_whole_table_quantiles_of_awkward_values(rows, monkeypatch):
    monkeypatch.setattr(skew, "RANK_VALUES", 3)
    monkeypatch.setattr(skew, "RANK_BINS", 4)
    inf, nan = float("inf"), float("nan")
    rng = np.random.default_rng(3)
    for values in (
        [*rng.normal(size=200), 1e12, -1e15], [-inf, 1.0, 2.0, 3.0, 4.0, 5.0, inf], [nan, 1.0, None, 2.0, nan],
        [1.5e308, -1.5e308, 0.0, 1.0, 2.0, 3.0], [7.0] * 50, [0.0] * 20 + [1.0] * 30,
    ):
        real = np.array([v for v in values if v is not None and v == v])
        df = rows("a double", [(None if v is None else float(v),) for v in values])
        wanted = {f"q{k}": Quantile("a", k / 10, False) for k in range(11)}
        row = grouped_quantiles(df, [], wanted, {"n": F.count("a")}).first()
        assert row["n"] == len(real)
        for k in range(11):
            assert row[f"q{k}"] == np.quantile(real, k / 10, method="inverted_cdf")


def test_hot_groups_are_found_in_a_sample(skewed):
    found = count_hot_groups({"big": skewed}, ["k"], 3000)["big"]
    assert [r["k"] for r in found.rows.collect()] == ["hot"] and found.count == 1
    plain = collected(grouped_quantiles(skewed, ["k"], WANTED, counted()))
    assert collected(grouped_quantiles(skewed, ["k"], WANTED, counted(), hot_rows=3000)) == plain


def test_group_quantiles_equal_those_of_spark_from_one_list_per_column(spark, monkeypatch):
    rng = random.Random(4)
    values = [None, 0.0, 1e300, float("inf"), float("-inf"), *(rng.uniform(-5, 5) for _ in range(6))]
    rows = [(k, rng.choice(values)) for k in [*range(40), None] for _ in range(rng.randint(1, 12))]
    df = spark.createDataFrame(rows, "k int, a double")
    shares = [0.0, 1e-05, 0.1, 0.25, 0.5, 0.9, 1.0]
    wanted = {f"q{i}": Quantile("a", p) for i, p in enumerate(shares)}
    wanted |= {f"d{i}": Quantile("a", p, False) for i, p in enumerate(shares)}
    found = grouped_quantiles(df, ["k"], wanted, {"n": F.count("a")})
    expected = df.groupBy("k").agg(
        *(F.percentile("a", F.lit(p)).alias(f"q{i}") for i, p in enumerate(shares)),
        *(F.expr(f"percentile_disc({p!r}) WITHIN GROUP (ORDER BY a)").alias(f"d{i}") for i, p in enumerate(shares)),
        F.count("a").alias("n"),
    )
    assert found.columns == expected.columns and collected(found) == collected(expected)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(") == 1 and "percentile" not in plan
