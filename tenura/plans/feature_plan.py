"""Feature recipe: fitted once on train, saved as one PipelineModel, applied anywhere.

All statistics come from three passes over train that combine on the map side. Medians and
quartiles are exact, so a refit on the same rows gives the same model whatever the
partitioning. Fitted values are written into SQLTransformer stages, so that they are saved
with the model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    MinMaxScaler,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions.columns import log_sql
from tenura.operators.explore import mode
from tenura.operators.skew import (
    HOT_ROWS,
    ColumnSummary,
    Quantile,
    grouped_quantiles,
    whole_table_quantiles,
)
from tenura.schemas import AMOUNT_FEATURES, CATEGORICAL_FEATURES, KEY, USAGE_FEATURES

FEATURES = "FEATURES"
LABEL = "label"


@dataclass(frozen=True)
class FeatureRecipe:
    """Which columns get which treatment, and in which order they enter the vector.

    Vector order: min-max columns, robust columns, standard columns, mode columns (also
    min-max scaled), then one slot per known category of each categorical column.
    """

    minmax: Sequence[str] = tuple(AMOUNT_FEATURES)
    robust: Sequence[str] = tuple(USAGE_FEATURES)
    standard: Sequence[str] = ("age", "account_balance")
    mode: Sequence[str] = ("registration_year",)
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES)
    upper_limits: Mapping[str, float] = field(default_factory=lambda: {"age": 100.0})

    @property
    def logged(self) -> list[str]:
        return [*self.minmax, *self.robust, *self.standard]


def add_columns(expressions: Mapping[str, str]) -> SQLTransformer:
    """Stage that adds columns given as SQL text."""
    added = ", ".join(f"{sql} AS `{name}`" for name, sql in expressions.items())
    return SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__")


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _literal(value: object) -> str:
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return _number(value) if isinstance(value, float) else str(value)


def log_stage(
    cols: Sequence[str], upper_limits: Mapping[str, float] | None = None, on_invalid: str = "null"
) -> SQLTransformer:
    """ln(1 + x) of each column, after capping, as ``<name>_log``. NaN is missing."""
    upper_limits = upper_limits or {}
    sql = {}
    for c in cols:
        value = f"nanvl(CAST(`{c}` AS DOUBLE), NULL)"
        if c in upper_limits:
            limit = _number(upper_limits[c])
            value = f"CASE WHEN {value} > {limit} THEN {limit} ELSE {value} END"
        sql[f"{c}_log"] = log_sql(value, on_invalid)
    return add_columns(sql)


def _require(found: Mapping[str, object], what: str) -> None:
    empty = sorted({name.split()[0] for name, value in found.items() if value is None})
    if empty:
        raise ValueError(f"no {what}: columns without any value in train: {empty}")


def fit_quantiles(
    train: DataFrame,
    medians: Sequence[str] = (),
    ranges: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> tuple[dict, dict]:
    """Medians of some columns and quartile distances of others, in one pass.

    Both are taken between values that occur in the column.
    """
    wanted = {f"{c} median": Quantile(c, 0.5, interpolate=False) for c in medians}
    for c in ranges:
        wanted[f"{c} low"] = Quantile(c, 0.25, interpolate=False)
        wanted[f"{c} high"] = Quantile(c, 0.75, interpolate=False)
    row = grouped_quantiles(train, [], wanted, hot_rows=hot_rows).first()
    _require(row.asDict(), "quantile")
    return (
        {c: row[f"{c} median"] for c in medians},
        {c: row[f"{c} high"] - row[f"{c} low"] for c in ranges},
    )


def fit_modes(train: DataFrame, cols: Sequence[str]) -> dict:
    """Most frequent non-null value of each column, the smallest of several."""
    rows = {c: mode(train, c).first() for c in cols}
    modes = {c: row[0] if row else None for c, row in rows.items()}
    _require(modes, "mode")
    return modes


def fill_stage(values: Mapping[str, object], suffix: str = "_filled") -> SQLTransformer:
    """Stage that replaces nulls by fitted values, as ``<name><suffix>``; NaN by numbers too."""
    sql = {}
    for c, v in values.items():
        column = f"nanvl(`{c}`, NULL)" if isinstance(v, float) else f"`{c}`"
        sql[f"{c}{suffix}"] = f"coalesce({column}, {_literal(v)})"
    return add_columns(sql)


def robust_stage(ranges: Mapping[str, float], suffix: str = "_robust") -> SQLTransformer:
    """Stage that divides by the quartile range; 0 where the range is 0."""
    return add_columns(
        {f"{c}{suffix}": f"`{c}` / {_number(r)}" if r else "CAST(0 AS DOUBLE)"
         for c, r in ranges.items()}
    )


def scaler_stages(cols: Sequence[str], kind: str, out: str) -> list:
    """Assemble columns and scale them: "minmax" to [0, 1], "standard" by deviation only."""
    scalers = {"minmax": MinMaxScaler, "standard": StandardScaler}
    if kind not in scalers:
        raise ValueError(f"kind must be one of {list(scalers)}, not {kind!r}")
    return [
        VectorAssembler(inputCols=list(cols), outputCol=f"{out}_raw"),
        scalers[kind](inputCol=f"{out}_raw", outputCol=out),
    ]


def onehot_stages(cols: Sequence[str]) -> list:
    """Index by falling frequency and encode; unseen and null values become all zero."""
    indexed = [f"{c}_index" for c in cols]
    return [
        StringIndexer(inputCols=list(cols), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_onehot" for c in cols]),
    ]


def scaled_stage(
    ranges: Mapping[str, tuple[float, float]], deviations: Mapping[str, float]
) -> SQLTransformer:
    """Stage that adds ``<name>_scaled``: to [0, 1] by the range, or by the deviation only.

    A column of one value becomes 0.5 and 0.
    """
    sql = {}
    for c, (low, high) in ranges.items():
        width = _number(high - low)
        sql[f"{c}_scaled"] = (
            f"(`{c}` - {_number(low)}) / {width}" if high > low else "CAST(0.5 AS DOUBLE)"
        )
    for c, deviation in deviations.items():
        sql[f"{c}_scaled"] = f"`{c}` / {_number(deviation)}" if deviation else "CAST(0 AS DOUBLE)"
    return add_columns(sql)


def count_categories(df: DataFrame, cols: Sequence[str]) -> dict[str, list[tuple[str, int]]]:
    """Values of several columns as text, by falling frequency, ties in order, from one pass."""
    if not cols:
        return {}
    named = [F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("value"))
             for i, c in enumerate(cols)]
    counts = df.select(F.inline(F.array(*named))).where("value IS NOT NULL").groupBy(
        "i", "value"
    ).agg(F.count(F.lit(1)).alias("n"))
    found: dict[str, list[tuple[str, int]]] = {c: [] for c in cols}
    for r in counts.collect():
        found[cols[r["i"]]].append((r["value"], r["n"]))
    return {c: sorted(v, key=lambda x: (-x[1], x[0])) for c, v in found.items()}


def fit_features(
    train: DataFrame,
    recipe: FeatureRecipe | None = None,
    on_invalid: str = "null",
    hot_rows: int = HOT_ROWS,
) -> PipelineModel:
    """Fit the whole recipe on train, from one table of statistics.

    Logs are taken before nulls are filled, so a value below the log domain is filled
    like a missing one. As the log is monotone, the fitted median is unaffected. One scan
    gives sketches, extremes and moments of all numbers, one more the exact medians and
    quartiles, one the counts of categories; the stages are written from these. Filling
    with a median or mode changes no extreme, and the deviation in a known way.
    """
    r = recipe or FeatureRecipe()
    logs = log_stage(r.logged, r.upper_limits, on_invalid)
    logged = [f"{c}_log" for c in r.logged]
    robust = [f"{c}_log" for c in r.robust]
    used = [*logged, *r.mode, *r.categorical]
    prepared = logs.transform(train).select(*used).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        wanted = {f"{c} median": Quantile(c, 0.5, interpolate=False) for c in logged}
        for c in robust:
            wanted[f"{c} low"] = Quantile(c, 0.25, interpolate=False)
            wanted[f"{c} high"] = Quantile(c, 0.75, interpolate=False)
        # The columns to scale take part with a quantile that costs nothing.
        wanted |= {f"{c} least": Quantile(c, 0.0, interpolate=False) for c in r.mode}
        summaries: dict[str, ColumnSummary] = {}
        found = whole_table_quantiles(prepared, wanted, summaries)
        _require(found, "quantile")
        counts = count_categories(prepared, [*r.mode, *r.categorical])
    finally:
        prepared.unpersist()
    medians = {c: found[f"{c} median"] for c in logged}
    widths = {f"{c}_filled": found[f"{c} high"] - found[f"{c} low"] for c in robust}
    modes = {c: counts[c][0][0] if counts[c] else None for c in r.mode}
    _require(modes, "mode")
    kinds = dict(prepared.dtypes)
    modes = {c: v if kinds[c] == "string" else float(v) if kinds[c] in ("double", "float") else int(v)
             for c, v in modes.items()}

    minmax = [f"{c}_log" for c in r.minmax] + list(r.mode)
    standard = [f"{c}_log" for c in r.standard]
    scaled = scaled_stage(
        {f"{c}_filled": (summaries[c].low, summaries[c].high) for c in minmax},
        {f"{c}_filled": summaries[c].deviation(medians[c]) for c in standard},
    )
    stages = [logs, fill_stage(medians | modes), robust_stage(widths), scaled]
    slots = [f"{c}_log_filled_scaled" for c in r.minmax] + [f"{c}_robust" for c in widths]
    slots += [f"{c}_filled_scaled" for c in [*standard, *r.mode]]
    if r.categorical:
        indexer, encoder = onehot_stages(r.categorical)
        labels = [[value for value, _ in counts[c]] for c in r.categorical]
        if empty := [c for c, values in zip(r.categorical, labels) if not values]:
            raise ValueError(f"no category: columns without any value in train: {empty}")
        indexers = [
            StringIndexerModel.from_labels(values, c, out, indexer.getHandleInvalid())
            for values, c, out in zip(labels, indexer.getInputCols(), indexer.getOutputCols())
        ]
        # The sizes of the categories are in the schema, so this starts no job.
        nothing = prepared.sparkSession.createDataFrame([], prepared.select(*r.categorical).schema)
        stages += [*indexers, encoder.fit(PipelineModel(indexers).transform(nothing))]
        slots += [f"{c}_onehot" for c in r.categorical]
    return PipelineModel([*stages, VectorAssembler(inputCols=slots, outputCol=FEATURES)])


def apply_features(
    model: Transformer, df: DataFrame, keep: Sequence[str] = (KEY, LABEL)
) -> DataFrame:
    """Feature vectors of any split: (key, FEATURES, label)."""
    key, *rest = keep
    return model.transform(df).select(key, FEATURES, *rest)


def spread_features(df: DataFrame, size: int, digits: int | None = None) -> DataFrame:
    """Replace the feature vector by plain columns f00, f01, ..."""
    values = vector_to_array(FEATURES)
    columns = {}
    for i in range(size):
        value = values[i]
        columns[f"f{i:02d}"] = value if digits is None else F.round(value, digits)
    return df.withColumns(columns).drop(FEATURES)
