"""Modelling rows of all tables in one grouped pass.

Every table gives narrow tagged rows; their union is shuffled once by the key, and one
aggregate makes the features, the user attributes, the population and the label of each
key. There is no join, whatever the number of tables, and a table that holds rows of several
kinds is scanned once for all of them.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions.columns import fill_zero
from tenura.operators.activity import GAP_DAYS, churned
from tenura.operators.feature_sets import DURATION_SQL, FEATURE_SETS, ranked_attributes_sql
from tenura.operators.skew import (
    HOT_ROWS,
    SEED,
    Quantile,
    count_hot_groups,
    grouped_quantiles,
    hot_sample_share,
)
from tenura.schemas import AMOUNT_FEATURES, KEY, TABLES, USAGE_FEATURES, USER_FEATURES

# A table with the kinds of rows it holds: the name of a subscriber table, and the SQL
# condition of its rows (None: all).
Source = tuple[DataFrame, Mapping[str, str | None]]

# When the rows of a kind happened, for the kinds that make the population and the label.
ACTIVITY_TIME = {"package": "activation_date", "recharge": "recharge_dt"}
FOLLOWING = "following"
POPULATION = "population"
USER = "user"
ACTIVE = "kind IN ('package', 'recharge')"
# Where the columns of a kind travel in the union, and how a column that isn't in the table is made.
_NUMBERS = ("number_0", "number_1", "number_2", "number_3")
_DERIVED = {"duration": DURATION_SQL}


def table_sources(tables: Mapping[str, DataFrame]) -> list[Source]:
    """Each of the six tables as a source of its own kind."""
    return [(tables[name], {name: None}) for name in TABLES]


def _carried(kind: str) -> dict[str, str]:
    """Column of the union that carries each column of a table."""
    return dict(zip(FEATURE_SETS[kind].columns(), _NUMBERS))


def _own_values(kind: str, as_of: datetime.date) -> dict[str, str]:
    """What a row of a kind carries, as SQL."""
    if kind == USER:
        return {"attributes": ranked_attributes_sql(as_of)}
    values = {to: _DERIVED.get(c, f"`{c}`") for c, to in _carried(kind).items()}
    if kind in ACTIVITY_TIME:
        values["ts"] = f"`{ACTIVITY_TIME[kind]}`"
    return values


@dataclass(frozen=True)
class _Tagged:
    """One tagged row that a row of a table gives, as SQL: its keys, values and condition."""

    kind: str
    keys: Mapping[str, str]
    values: Mapping[str, str]
    condition: str = "true"

    def columns(self, types: Mapping[str, str]) -> dict[str, str]:
        found = {**self.keys, "kind": f"'{self.kind}'"}
        return found | {c: f"CAST({self.values.get(c, 'NULL')} AS {t})" for c, t in types.items()}


def _union(parts: Sequence[tuple[DataFrame, list[_Tagged]]], types: Mapping[str, str]) -> DataFrame:
    """Rows of all parts: each row of a table gives one for every condition that holds."""
    unions = []
    for df, rows in parts:
        if len(rows) == 1:
            columns = rows[0].columns(types)
            unions.append(
                df.where(rows[0].condition).selectExpr(*(f"{v} AS `{c}`" for c, v in columns.items()))
            )
            continue
        structs = []
        for row in rows:
            fields = ", ".join(f"'{c}', {v}" for c, v in row.columns(types).items())
            structs.append(f"CASE WHEN {row.condition} THEN named_struct({fields}) END")
        # A condition that doesn't hold gives a row of nulls.
        unions.append(df.selectExpr(f"inline(array({', '.join(structs)}))").where("kind IS NOT NULL"))
    return reduce(DataFrame.unionAll, unions)


def _types(sources: Sequence[Source], as_of: datetime.date) -> tuple[dict[str, str], dict[str, str]]:
    """Types of the union's columns, and of the sums: those of whole numbers stay whole.

    They are exact up to 2**53, as they travel as doubles.
    """
    types = dict.fromkeys(_NUMBERS, "double")
    sums = {}
    for df, kinds in sources:
        for kind in kinds:
            if kind == USER:
                (field,) = df.selectExpr(f"{ranked_attributes_sql(as_of)} AS a").schema
                types["attributes"] = field.dataType.simpleString()
                continue
            if kind in ACTIVITY_TIME:
                types["ts"] = df.schema[ACTIVITY_TIME[kind]].dataType.simpleString()
            for name, column in FEATURE_SETS[kind].sums.items():
                whole = df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long")
                sums[name] = "bigint" if whole else "double"
    return types, sums


def _wide(tagged: DataFrame) -> DataFrame:
    """One column per median, beside the tagged columns."""
    return tagged.selectExpr("*", *(
        f"CASE WHEN kind = '{table}' THEN nanvl({_carried(table)[column]}, NULL) END AS `{name}`"
        for table, features in FEATURE_SETS.items()
        for name, column in features.medians.items()
    ))


def _feature_aggregates(sums: Mapping[str, str]) -> dict[str, Column]:
    found = {}
    for table, features in FEATURE_SETS.items():
        if features.count:
            found[features.count] = f"count_if(kind = '{table}')"
        for name, column in features.sums.items():
            value = f"CASE WHEN kind = '{table}' THEN {_carried(table)[column]} END"
            found[name] = f"CAST(sum({value}) AS {sums.get(name, 'double')})"
    found["attributes"] = "min(attributes)"
    return {name: F.expr(sql) for name, sql in found.items()}


def _grouped(
    parts: Sequence[tuple[DataFrame, list[_Tagged]]],
    types: Mapping[str, str],
    sums: Mapping[str, str],
    keys: Sequence[str],
    population: str,
    label: Mapping[str, str],
    hot_rows: int,
) -> DataFrame:
    """One row per key of the population, from the tagged rows of all parts.

    Keys with very many rows are looked for in the key columns of the tables first.
    """
    medians = {n: Quantile(n) for fs in FEATURE_SETS.values() for n in fs.medians}
    aggregates = _feature_aggregates(sums) | {
        name: F.expr(sql) for name, sql in {"in_population": f"max({population})", **label}.items()
    }
    complete = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    share = hot_sample_share(hot_rows)
    sampled = [(df if share == 1.0 else df.sample(share, seed=SEED), rows) for df, rows in parts]
    key_rows = {"rows": _union(sampled, {}).where(complete)}
    hot = count_hot_groups(key_rows, keys, hot_rows, sampled=True)["rows"]
    tagged = _union(parts, types).where(complete)
    found = grouped_quantiles(
        tagged, keys, medians, aggregates, hot, hot_rows, prepare=_wide, nan=True
    )
    return found.where("in_population")


def _finish(found: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    activity = AMOUNT_FEATURES + USAGE_FEATURES
    return fill_zero(found, activity).selectExpr(
        *(f"`{k}`" for k in keys), f"{label} AS label", *activity,
        *(f"attributes.`{c}` AS `{c}`" for c in USER_FEATURES),
    )


def population_dataset(
    sources: Sequence[Source],
    population: DataFrame | None,
    as_of: datetime.date,
    keys: Sequence[str] = (KEY,),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Features of the keys of a population, one row per key: keys, label, features.

    ``population`` holds keys and their label, known or null. Without one, it is the keys
    that have package or recharge rows, their label unknown.
    """
    types, sums = _types(sources, as_of)
    types["label"] = "int"
    named = {k: f"`{k}`" for k in keys}
    parts = [
        (df, [_Tagged(kind, named, _own_values(kind, as_of), condition or "true")
              for kind, condition in kinds.items()])
        for df, kinds in sources
    ]
    member = ACTIVE
    if population is not None:
        parts.append((population, [_Tagged(POPULATION, named, {"label": "label"})]))
        member = f"kind = '{POPULATION}'"
    found = _grouped(parts, types, sums, keys, member, {"label": "max(label)"}, hot_rows)
    return _finish(found, keys, "label")


def labelled_dataset(
    sources: Sequence[Source],
    months: Sequence[str],
    as_of: datetime.date,
    month_col: str = "month",
    wanted: Sequence[str] | None = None,
    keys: Sequence[str] = (KEY,),
    gap_days: int = GAP_DAYS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Labelled features of consecutive months in one pass: month, keys, label, features.

    Every source has a column ``month_col``. A key is in the population of the months in
    which it has package or recharge rows. Its label is that of ``churn_labels``; in the last
    of ``months`` it is null. Only rows of the ``wanted`` months (all, if not given) are made;
    the month after each of them is read for the label alone.
    """
    wanted = list(months if wanted is None else wanted)
    if unknown := set(wanted) - set(months):
        raise ValueError(f"wanted months {sorted(unknown)} are not among {list(months)}")
    types, sums = _types(sources, as_of)
    month = f"`{month_col}`"
    own = {month_col: month, **{k: f"`{k}`" for k in keys}}
    before = {later: month_ for month_, later in zip(months, months[1:]) if month_ in wanted}
    earlier = " ".join(f"WHEN {sql_text(m)} THEN {sql_text(b)}" for m, b in before.items())

    def among(names: Iterable[str]) -> str:
        return f"{month} IN ({', '.join(map(sql_text, names))})"

    parts = []
    for df, kinds in sources:
        rows = []
        for kind, condition in kinds.items():
            condition = f"({condition or 'true'})"
            values = _own_values(kind, as_of)
            rows.append(_Tagged(kind, own, values, f"{condition} AND {among(wanted)}"))
            if kind in ACTIVITY_TIME and before:
                keys_before = {**own, month_col: f"CASE {month} {earlier} END"}
                rows.append(_Tagged(
                    FOLLOWING, keys_before, {"ts": values["ts"]}, f"{condition} AND {among(before)}"
                ))
        parts.append((df.where(among(dict.fromkeys([*wanted, *before]))), rows))
    bounds = {
        "last_seen": f"max(CASE WHEN {ACTIVE} THEN ts END)",
        "first_next": f"min(CASE WHEN kind = '{FOLLOWING}' THEN ts END)",
    }
    all_keys = [month_col, *keys]
    found = _grouped(parts, types, sums, all_keys, ACTIVE, bounds, hot_rows)
    found = found.withColumn("label", churned(F.col("last_seen"), F.col("first_next"), gap_days))
    return _finish(found, all_keys, f"CASE WHEN {month} <> {sql_text(months[-1])} THEN label END")


def sql_text(value: str) -> str:
    """A string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
