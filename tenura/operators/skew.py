"""Joins and exact quantiles that hold when one group has a large share of the rows.

A group with more than ``hot_rows`` rows is never gathered in one task. Quantiles of
ordinary groups are plain grouped aggregates. Those of hot groups take two more passes
over the hot rows, both combined on the map side: a mergeable sketch brackets every
wanted rank, then the rows inside the brackets are counted per distinct value. Quantiles of
a whole table are found alike, from sketches that are merged in two levels; brackets of very
many rows are counted in bins first. So no task and no sketch holds more than the bins.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.sources.shared import cut_lineage

# One group's percentile buffer holds up to this many distinct values in a task.
HOT_ROWS = 200_000
# Rows of a group of that size in the sample that hot groups are looked for in.
SAMPLED_ROWS_OF_HOT = 2_000
SEED = 11
# Bins of a pass for a whole table's quantiles, and values that are counted one by one. With
# the brackets below, three scans are enough for 2e11 rows, two for 13 million.
RANK_BINS = 16_384
RANK_VALUES = 20_000
# Size of a whole table's sketches, and how far a rank may be off, as a share of the rows:
# twice the normalized error that such a sketch keeps to with 99 % confidence.
SKETCH_SIZE = 8192
SKETCH_MARGIN = 2 * 2.296 / SKETCH_SIZE**0.9723
# Tasks' sketches are merged in so many groups, and these in one task.
SKETCH_GROUPS = 1024
# A table with at most this many rows may be broadcast.
BROADCAST_ROWS = 20_000
# Copies of the small side in a salted join when it is too long to broadcast.
SALTS = 64
# Ranks are bracketed to within rows / SKETCH_ACCURACY.
SKETCH_ACCURACY = 50_000


@dataclass(frozen=True)
class HotGroups:
    """Groups above a row limit: their keys, and how many there are."""

    rows: DataFrame | None
    count: int


NO_HOT_GROUPS = HotGroups(None, 0)


def hot_sample_share(hot_rows: int = HOT_ROWS) -> float:
    """Share of all rows in which a group of ``hot_rows`` rows still has thousands."""
    return min(1.0, SAMPLED_ROWS_OF_HOT / max(hot_rows, 1))


def count_hot_groups(
    tables: Mapping[str, DataFrame],
    keys: Sequence[str],
    hot_rows: int = HOT_ROWS,
    sampled: bool = False,
) -> dict[str, HotGroups]:
    """Find the hot groups of several tables in one job that reads only the key columns.

    Groups are counted on a sample in which a group of ``hot_rows`` rows still has
    thousands; half the expected number makes a group hot, so none of that size is
    missed. Results never depend on which groups are found, only their cost does. Tables
    that are ``sampled`` are such samples already.
    """
    share = hot_sample_share(hot_rows)
    limit = hot_rows if share == 1.0 else hot_rows * share / 2
    tagged = []
    for name, df in tables.items():
        key_rows = df.select(F.lit(name).alias("source"), *keys)
        tagged.append(key_rows if sampled or share == 1.0 else key_rows.sample(share, seed=SEED))
    sizes = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("source", *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > limit)
        .drop("n")
    )

    def per_table() -> dict[str, int]:
        counts = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("groups"))
        return {r["source"]: r["groups"] for r in counts.collect()}

    if not per_table():
        return dict.fromkeys(tables, NO_HOT_GROUPS)
    sizes = cut_lineage(sizes)
    found = per_table()
    return {
        name: HotGroups(sizes.where(F.col("source") == name).drop("source"), found[name])
        if name in found else NO_HOT_GROUPS
        for name in tables
    }


def join_small(
    rows: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    small_rows: int | None = None,
) -> DataFrame:
    """Join rows of any skew to a table with one row per key; null keys match.

    The small side is checkpointed and counted first, unless the caller knows its length,
    and broadcast only when short. Otherwise it is replicated over salts and shuffled,
    which spreads the rows of one key over as many tasks. Without keys the small side is
    a single row, whose values become constants.
    """
    if not keys:
        return _with_constants(rows, small)
    if small_rows is None:
        small = cut_lineage(small)
        small_rows = small.count()
    side = small.withColumnsRenamed({k: f"_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    if small_rows <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(side), reduce(Column.__and__, match), how)
        return joined.drop(*(f"_{k}" for k in keys))
    # Rows of one input split share a salt: the same after a task is retried.
    salted = rows.withColumn("_row_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    match.append(F.col("_row_salt") == F.col("_salt"))
    joined = salted.join(side, reduce(Column.__and__, match), how)
    return joined.drop("_row_salt", "_salt", *(f"_{k}" for k in keys))


def _with_constants(rows: DataFrame, single: DataFrame) -> DataFrame:
    row = single.first()
    if row is None:
        return rows.where(F.lit(False)).select(
            "*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in single.schema)
        )
    return rows.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in single.schema})


@dataclass(frozen=True)
class Quantile:
    """A wanted quantile of a numeric column: interpolated, or the observed value."""

    col: str
    p: float = 0.5
    interpolate: bool = True

    def of_sorted(self, values: str) -> Column:
        """The quantile of a sorted array of doubles, given as SQL; null of an empty one."""
        n = f"size({values})"
        if not self.interpolate:
            return F.expr(f"get({values}, CAST(greatest(ceil({self.p!r}D * {n}) - 1, 0) AS INT))")
        at = f"({self.p!r}D * ({n} - 1))"
        low, high = (f"get({values}, CAST({end}({at}) AS INT))" for end in ("floor", "ceil"))
        between = f"(ceil({at}) - {at}) * {low} + ({at} - floor({at})) * {high}"
        return F.expr(f"CASE WHEN {low} = {high} THEN {low} ELSE {between} END")

    def ranks(self, n: Column) -> tuple[Column, Column, Column]:
        """Lower rank, upper rank (from 0) and the weight of the upper one."""
        if self.interpolate:
            at = F.lit(self.p) * (n - 1)
            return F.floor(at), F.ceil(at), at - F.floor(at)
        rank = F.greatest(F.ceil(F.lit(self.p) * n) - 1, F.lit(0))
        return rank, rank, F.lit(0.0)


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    quantiles: Mapping[str, Quantile],
    aggregates: Mapping[str, Column] | None = None,
    hot: HotGroups | None = None,
    hot_rows: int = HOT_ROWS,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    nan: bool = False,
) -> DataFrame:
    """Exact quantiles and other aggregates per group, one row per group.

    ``aggregates`` must combine on the map side (count, sum, min, max, average). With no
    keys the whole table is one group. Null and NaN values are missing: ignored in the
    columns of the quantiles, also by ``aggregates``; a group without values has null
    quantiles.

    ``df`` should hold no columns beyond those used. ``prepare`` derives further columns from
    them row by row; it is applied after the shuffle, so that only ``df``'s are shuffled. With
    ``nan`` it has turned NaN into null already.
    """
    prepare = prepare or (lambda rows: rows)
    aggregates = {name: agg.alias(name) for name, agg in (aggregates or {}).items()}
    names = [*keys, *quantiles, *aggregates]
    # One list of doubles per column: percentile() keeps a hash map per group and quantile.
    lists = {c: f"_values_{j}" for j, c in enumerate(dict.fromkeys(q.col for q in quantiles.values()))}
    plain = [F.collect_list(F.col(c).cast("double")).alias(v) for c, v in lists.items()]
    plain += [*aggregates.values()]

    def grouped(rows: DataFrame) -> DataFrame:
        found = prepared(rows.repartition(*keys)).groupBy(*keys).agg(*plain)
        found = found.withColumns({v: F.sort_array(v) for v in lists.values()})
        exact = {name: q.of_sorted(lists[q.col]).alias(name) for name, q in quantiles.items()}
        return found.select(*keys, *exact.values(), *aggregates)

    columns: set[str] = set()
    if not nan:
        kinds = prepare(df).schema
        floats = {f.name for f in kinds if f.dataType.typeName() in ("double", "float")}
        columns = {q.col for q in quantiles.values()} & floats - set(keys)

    def prepared(rows: DataFrame) -> DataFrame:
        made = {c: F.nanvl(c, F.lit(None)) for c in sorted(columns)}
        return prepare(rows).withColumns(made) if made else prepare(rows)

    if not keys:
        return _whole_table(prepared(df), quantiles, aggregates)

    if hot is None:
        hot = count_hot_groups({"rows": df}, keys, hot_rows)["rows"]
    # Values of a key seldom repeat, so combining them before the shuffle would cost more
    # than it saves; with the hot groups apart, the rows of a key are few.
    if not hot.count:
        return grouped(df)
    cold = grouped(join_small(df, hot.rows, keys, "left_anti", hot.count))
    rows = prepared(join_small(df, hot.rows, keys, "left_semi", hot.count))
    exact = _hot_groups(rows, keys, quantiles, aggregates, hot.count)
    return cold.select(names).unionByName(exact.select(names))


def _double(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _inside(v: str, low: float, high: float) -> str:
    return f"{v} BETWEEN {_double(low)} AND {_double(high)}"


def _bins(v: str, low: float, high: float) -> str:
    """SQL for the number of the bin of v in [low, high]: rises with v."""
    if math.isinf(low) or math.isinf(high):
        return f"CASE WHEN {v} = {_double(low)} THEN 0 WHEN {v} = {_double(high)} THEN 2 ELSE 1 END"
    half = high / 2 - low / 2  # high - low may be beyond a double
    place = f"floor(({v} / 2 - {_double(low / 2)}) / {_double(half)} * {RANK_BINS})"
    return f"CAST(least({place}, {RANK_BINS - 1}) AS INT)"


def _whole_table(
    df: DataFrame, quantiles: Mapping[str, Quantile], aggregates: Mapping[str, Column]
) -> DataFrame:
    """One row of exact quantiles and aggregates of all rows."""
    row = whole_table_quantiles(df, quantiles)
    single = df.sparkSession.range(1).select(
        *(F.lit(v).cast("double").alias(n) for n, v in row.items())
    )
    if not aggregates:
        return single
    summary = df.agg(*aggregates.values())
    found = summary.first()
    return single.select("*", *(
        F.lit(found[f.name]).cast(f.dataType).alias(f.name) for f in summary.schema
    ))


@dataclass(frozen=True)
class ColumnSummary:
    """Values of a column: their number, extremes, mean and squared deviations from it.

    ``rows`` counts those without a value too; ``brackets`` are of ranks that may be a little off.
    """

    n: int
    low: float | None
    high: float | None
    brackets: tuple[tuple[float, float], ...] = ()
    rows: int = 0
    mean: float = 0.0
    squares: float = 0.0

    def deviation(self, fill: float) -> float:
        """Sample deviation of the column with its nulls replaced by ``fill``."""
        gaps = self.rows - self.n
        squares = self.squares + (fill - self.mean) ** 2 * self.n * gaps / max(self.rows, 1)
        return math.sqrt(squares / (self.rows - 1)) if self.rows > 1 else 0.0


def _moments(parts: Sequence) -> tuple[float, float]:
    """Mean and squared deviations of all values from those of parts: (n, mean, variance)."""
    n, mean, squares = 0, 0.0, 0.0
    for part in parts:
        if part["n"]:
            away = part["mean"] - mean
            both = n + part["n"]
            squares += part["n"] * part["variance"] + away * away * n * part["n"] / both
            mean += away * part["n"] / both
            n = both
    return mean, squares


def sketch_columns(
    values: DataFrame, shares: Mapping[str, Sequence[float]], margin: float = SKETCH_MARGIN
) -> dict[str, ColumnSummary]:
    """Summary of several numeric columns in one scan, with brackets of ranks given as shares.

    Every task sketches its rows; the sketches are merged in groups, then the groups' ones in
    one task, so that no task reads more than a bounded number of them for each column.
    """
    # As SQL text: the expressions are many, and each Column costs several calls to the JVM.
    def together(template: str) -> str:
        return ", ".join(template.format(c=c, k=SKETCH_SIZE) for c in shares)

    first = together(
        "count({c}) AS n_{c}, min({c}) AS low_{c}, max({c}) AS high_{c}, "
        "kll_sketch_agg_double({c}, {k}) AS sketch_{c}, "
        "struct(count({c}) AS n, avg({c}) AS mean, var_pop({c}) AS variance) AS moments_{c}"
    )
    parts = values.selectExpr("*", f"spark_partition_id() % {SKETCH_GROUPS} AS part").groupBy(
        "part"
    ).agg(F.expr(f"struct(count(1) AS rows, {first})").alias("s")).select("s.*")
    merged = parts.selectExpr("sum(rows) AS rows", *(
        sql.format(c=c, k=SKETCH_SIZE) for c in shares for sql in (
            "sum(n_{c}) AS n_{c}", "min(low_{c}) AS low_{c}", "max(high_{c}) AS high_{c}",
            "kll_merge_agg_double(sketch_{c}, {k}) AS sketch_{c}",
            "collect_list(moments_{c}) AS moments_{c}",
        )
    ))
    wanted = ["rows"]
    for c, at in shares.items():
        wanted += [f"n_{c}", f"low_{c}", f"high_{c}", f"moments_{c}"]
        around = [e for p in at for e in (max(0.0, p - margin), min(1.0, p + margin))]
        if around:
            ranks = ", ".join(f"{e!r}D" for e in around)
            found = f"kll_sketch_get_quantile_double(sketch_{c}, array({ranks}))"
            wanted.append(f"CASE WHEN n_{c} > 0 THEN {found} END AS at_{c}")
    row = merged.selectExpr(*wanted).first().asDict()
    summaries = {}
    for c, at in shares.items():
        bounds = row.get(f"at_{c}") or []
        pairs = tuple(zip(bounds[::2], bounds[1::2]))
        mean, squares = _moments(row[f"moments_{c}"])
        summaries[c] = ColumnSummary(
            row[f"n_{c}"] or 0, row[f"low_{c}"], row[f"high_{c}"], pairs, row["rows"] or 0, mean, squares
        )
    return summaries


def whole_table_quantiles(
    df: DataFrame,
    quantiles: Mapping[str, Quantile],
    summaries: dict[str, ColumnSummary] | None = None,
) -> dict[str, float | None]:
    """Exact quantiles of all rows; null for columns without values. NaN must be null in df.

    One scan sketches the columns, which brackets every wanted rank. The next one counts the
    rows below each bracket, and inside it the rows of each value, or of each of RANK_BINS bins
    if there are too many; then one more counts the values of the one bin that holds the rank.
    A rank outside its bracket is sought in bins of the whole range. All counts combine on the
    map side, and the driver sees a bounded number of them. ``summaries``, if given, receives
    the summary of each column.
    """
    cols = list(dict.fromkeys(q.col for q in quantiles.values()))
    values = df.select(*(F.col(c).cast("double").alias(f"v{j}") for j, c in enumerate(cols)))
    shares = {
        f"v{j}": list(dict.fromkeys(q.p for q in quantiles.values() if q.col == c))
        for j, c in enumerate(cols)
    }
    found = sketch_columns(values, shares)
    if summaries is not None:
        summaries.update({c: found[f"v{j}"] for j, c in enumerate(cols)})

    ranks = {}
    for name, q in quantiles.items():
        j = cols.index(q.col)
        n = found[f"v{j}"].n
        if n:
            at = q.p * (n - 1) if q.interpolate else max(math.ceil(q.p * n) - 1, 0)
            ranks[name] = (j, math.floor(at), math.ceil(at), at - math.floor(at))
    # For each sought (column, rank): rows below, rows inside, smallest and largest inside.
    spans = {}
    brackets: dict[tuple[int, float, float], set[int]] = {}
    for name, (j, low, high, _) in ranks.items():
        whole = found[f"v{j}"]
        for rank in (low, high):
            spans[j, rank] = (0, whole.n, whole.low, whole.high)
            if rank in (0, whole.n - 1):
                end = whole.low if rank == 0 else whole.high
                spans[j, rank] = (rank, 1, end, end)
            elif whole.n > RANK_VALUES:
                at = shares[f"v{j}"].index(quantiles[name].p)
                brackets.setdefault((j, *whole.brackets[at]), set()).add(rank)

    def narrow(j: int, rank: int, below: int, bins: list) -> bool:
        """Go on with the bin that holds the rank; False if none does."""
        for low, high, rows in bins:
            if below <= rank < below + rows:
                spans[j, rank] = (below, rows, low, high)
                return True
            below += rows
        return False

    if brackets:
        for (j, low, high), (below, bins) in _count_brackets(
            values, [(*key, found[f"v{key[0]}"].n) for key in brackets]
        ).items():
            for rank in brackets[j, low, high]:
                narrow(j, rank, below, bins)

    def counted(open_: list, place) -> dict:
        """Rows of each sought interval by their place, with least and largest value."""
        tagged = []
        for t, (j, rank) in enumerate(open_):
            _, _, low, high = spans[j, rank]
            one = f"struct({t} AS t, {place(f'v{j}', low, high)} AS place, v{j} AS v)"
            tagged.append(f"CASE WHEN {_inside(f'v{j}', low, high)} THEN {one} END")
        rows = values.selectExpr(f"inline(array({', '.join(tagged)}))").where("t IS NOT NULL")
        totals = rows.groupBy("t", "place").agg(
            F.expr("struct(count(1) AS rows, min(v) AS low, max(v) AS high)").alias("s")
        ).select("t", "s.*")
        parts: dict = {key: [] for key in open_}
        for t, number, low, high in totals.collect():
            parts[open_[t]].append((low, high, number))
        return {key: sorted(p) for key, p in parts.items()}

    def descend(parts: dict) -> None:
        for (j, rank), bins in parts.items():
            narrow(j, rank, spans[j, rank][0], bins)

    while open_ := [k for k, (_, n, low, high) in spans.items() if n > RANK_VALUES and low < high]:
        descend(counted(open_, _bins))
    if last := [k for k, (_, _, low, high) in spans.items() if low < high]:
        descend(counted(last, lambda v, low, high: v))

    row: dict[str, float | None] = {}
    for name in quantiles:
        row[name] = None
        if name in ranks:
            j, low, high, weight = ranks[name]
            a, b = spans[j, low][2], spans[j, high][2]
            row[name] = a if weight == 0 else a * (1 - weight) + b * weight
    return row


def _count_brackets(
    values: DataFrame, brackets: Sequence[tuple[int, float, float, int]]
) -> dict[tuple[int, float, float], tuple[int, list[tuple[float, float, int]]]]:
    """Rows below each bracket (column, low, high, rows of the column), and rows of its values.

    Values are (least, largest, rows) in order: single ones, or bins if very many rows are to
    be expected. One scan: rows outside every bracket fall into one group, which counts those
    below each of them.
    """
    kept, aggregates, targets = [], ["count(1) AS rows"], []
    for t, (j, low, high, n) in enumerate(brackets):
        v = f"v{j}"
        inside = _inside(v, low, high)
        few = 2 * SKETCH_MARGIN * n <= RANK_VALUES or low == high
        place = v if few else f"CAST({_bins(v, low, high)} AS DOUBLE)"
        kept.append(f"CASE WHEN {inside} THEN {place} END AS k{t}")
        aggregates += [
            f"count_if({v} < {_double(low)}) AS below{t}",
            f"min(CASE WHEN {inside} THEN {v} END) AS low{t}",
            f"max(CASE WHEN {inside} THEN {v} END) AS high{t}",
        ]
        nothing = "CAST(NULL AS DOUBLE)"
        targets.append(
            f"struct({t} AS t, {nothing} AS place, below{t} AS rows, {nothing} AS low, {nothing} AS high)"
        )
        targets.append(
            f"CASE WHEN k{t} IS NOT NULL THEN struct({t} AS t, k{t} AS place, rows, "
            f"low{t} AS low, high{t} AS high) END"
        )
    names = [f"k{t}" for t in range(len(brackets))]
    combined = values.selectExpr("*", *kept).groupBy(*names).agg(
        F.expr(f"struct({', '.join(aggregates)})").alias("s")
    ).select(*names, "s.*")
    each = combined.selectExpr(f"inline(array({', '.join(targets)}))").where("t IS NOT NULL")
    counted = each.groupBy("t", "place").agg(
        F.expr("struct(sum(rows) AS rows, min(low) AS low, max(high) AS high)").alias("s")
    ).select("t", "place", "s.*")
    below = dict.fromkeys(range(len(brackets)), 0)
    bins: dict[int, list] = {t: [] for t in below}
    for t, place, rows, low, high in counted.collect():
        if place is None:
            below[t] = rows
        else:
            bins[t].append((low, high, rows))
    return {(j, low, high): (below[t], sorted(bins[t])) for t, (j, low, high, _) in enumerate(brackets)}


def _hot_groups(
    rows: DataFrame,
    keys: Sequence[str],
    quantiles: Mapping[str, Quantile],
    aggregates: Mapping[str, Column],
    groups: int,
) -> DataFrame:
    exact = _hot_quantiles(rows, list(keys), quantiles, groups)
    if not aggregates:
        return exact
    combined = rows.groupBy(*keys).agg(*aggregates.values())
    return join_small(exact, combined, keys, "inner", groups)


def _hot_quantiles(
    rows: DataFrame, keys: list[str], quantiles: Mapping[str, Quantile], groups: int
) -> DataFrame:
    wanted = list(quantiles.values())
    cols = list(dict.fromkeys(q.col for q in wanted))
    values = rows.select(
        *keys, *(F.col(c).cast("double").alias(f"v{j}") for j, c in enumerate(cols))
    )

    # One sketch per column brackets all its quantiles, two bounds each.
    margin = 3 / SKETCH_ACCURACY
    sketches = []
    for j, col in enumerate(cols):
        around = []
        for q in wanted:
            if q.col == col:
                around += [max(0.0, q.p - margin), min(1.0, q.p + margin)]
        found = F.percentile_approx(f"v{j}", around, SKETCH_ACCURACY)
        # With few values the margin is less than a rank; all of them are counted instead.
        few = F.count(f"v{j}") < SKETCH_ACCURACY
        everything = F.array(F.lit(float("-inf")), F.lit(float("nan")))
        everything = F.flatten(F.array_repeat(everything, len(around) // 2))
        sketches.append(F.count(f"v{j}").alias(f"n{j}"))
        sketches.append(F.when(few, everything).otherwise(found).alias(f"b{j}"))
    brackets = cut_lineage(values.groupBy(*keys).agg(*sketches))

    # Rows outside every bracket fall into one group per key, which counts the values
    # below each bracket; rows inside one keep their value.
    column = [cols.index(q.col) for q in wanted]
    bounds = []
    for i, j in enumerate(column):
        at = 2 * column[:i].count(j)
        bounds.append((F.col(f"b{j}")[at], F.col(f"b{j}")[at + 1]))
    kept = []
    for j in range(len(cols)):
        inside = [F.col(f"v{j}").between(*bounds[i]) for i in range(len(wanted)) if column[i] == j]
        kept.append(F.when(reduce(Column.__or__, inside), F.col(f"v{j}")).alias(f"k{j}"))
    below = [
        F.count_if(F.col(f"v{j}") < bounds[i][0]).alias(f"below{i}") for i, j in enumerate(column)
    ]
    combined = (
        join_small(values, brackets, keys, "inner", groups)
        .groupBy(*keys, *kept)
        .agg(F.count(F.lit(1)).alias("copies"), *below)
    )

    targets = []
    for i, j in enumerate(column):
        name = [F.lit(i).alias("t"), F.col(f"n{j}").alias("n")]
        nothing = F.lit(None).cast("double").alias("v")
        targets.append(F.struct(*name, nothing, F.col(f"below{i}").alias("copies")))
        hit = F.struct(*name, F.col(f"k{j}").alias("v"), F.col("copies"))
        targets.append(F.when(F.col(f"k{j}").between(*bounds[i]), hit))
    counted = (
        join_small(combined, brackets, keys, "inner", groups)
        .select(*keys, F.inline(F.array_compact(F.array(*targets))))
        .groupBy(*keys, "t", "n", "v")
        .agg(F.sum("copies").alias("copies"))
    )

    # The below count has v null and sorts first, so a running sum gives global ranks.
    running = Window.partitionBy(*keys, "t").orderBy(F.col("v").asc_nulls_first())
    upto = F.sum("copies").over(running.rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("copies"))

    def pick(which: int) -> Column:
        rank = F.lit(None).cast("bigint")
        for i, q in enumerate(wanted):
            rank = F.when(F.col("t") == i, q.ranks(F.col("n"))[which]).otherwise(rank)
        covers = F.col("v").isNotNull() & (F.col("before") <= rank) & (rank < F.col("upto"))
        return F.max(F.when(covers, F.col("v")))

    picked = ranked.groupBy(*keys, "t", "n").agg(pick(0).alias("low"), pick(1).alias("high"))
    missed = F.raise_error(F.lit("rank outside its sketch bracket")).cast("double")
    results = []
    for i, (name, q) in enumerate(quantiles.items()):
        weight = q.ranks(F.col("n"))[2]
        value = F.col("low") * (1 - weight) + F.col("high") * weight
        value = F.when(weight == 0, F.col("low")).otherwise(value)
        found = F.col("low").isNotNull() & F.col("high").isNotNull()
        value = F.when(found, value).when(F.col("n") > 0, missed)
        results.append(F.max(F.when(F.col("t") == i, value)).alias(name))
    return picked.groupBy(*keys).agg(*results)
