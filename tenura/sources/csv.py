"""CSV landing files read against a declared schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tenura.functions.columns import date_parsers, parse_dates
from tenura.schemas import DATE_COLUMNS, TIMESTAMP_COLUMNS, raw_schema

# The line of a row that could not be read whole, and the same in its text cells.
_LINE, _MISSHAPEN = "_line", "_misshapen"


def _by_header(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType, options: dict[str, str]
) -> dict[tuple[str, ...], list[str]]:
    """Paths by the order of the names in their header lines."""
    found: dict[tuple[str, ...], list[str]] = {}
    for path in [paths] if isinstance(paths, str) else paths:
        header = spark.read.options(**options).csv(path, header=True).columns
        if sorted(header) != sorted(schema.names):
            raise ValueError(f"{path} has columns {header}, declared are {schema.names}")
        found.setdefault(tuple(header), []).append(path)
    return found


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType, **options: str
) -> DataFrame:
    """Read CSV by header name, in declared column order and with declared types.

    Only the header line of each path is looked at before the scan. Paths that share
    a header order are scanned together. A header that does not hold exactly the
    declared names raises ValueError; a malformed cell becomes null.
    """
    # enforceSchema=False makes the scan check the header of every file it opens.
    parts = [
        spark.read.options(**options)
        .schema(StructType([schema[name] for name in header]))
        .csv(group, header=True, enforceSchema=False)
        .select(schema.names)
        for header, group in _by_header(spark, paths, schema, options).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def read_landing_table(spark: SparkSession, table: str, paths: str | Sequence[str]) -> DataFrame:
    """One of the six declared tables, with its dates parsed."""
    raw = read_csv(spark, paths, raw_schema(table))
    return parse_dates(raw, TIMESTAMP_COLUMNS[table], DATE_COLUMNS[table])


def _reject(column: str | None, text: Column, is_bad: Column) -> Column:
    return F.when(
        is_bad, F.struct(F.lit(column).cast("string").alias("column"), text.alias("text"))
    )


def rejected_cells(
    spark: SparkSession, table: str, paths: str | Sequence[str], **options: str
) -> DataFrame:
    """file, column, text of every cell that ``read_landing_table`` turns into null.

    A number that can't be read as its declared type, or a date not in its format. A line with
    more or fewer cells than the header is reported whole, with a null column, besides its
    cells. Empty cells are no rejects. One scan; only lines with a reject are parsed twice.
    """
    schema = raw_schema(table)
    parts = []
    for header, group in _by_header(spark, paths, schema, options).items():
        typed = StructType([schema[name] for name in header]).add(_LINE, "string")
        # Only a scan of all columns sees that a line has too many or too few cells.
        rows = (
            spark.read.options(**options)
            .option("columnPruning", False)
            .schema(typed)
            .csv(group, header=True, enforceSchema=False, columnNameOfCorruptRecord=_LINE)
            .select("*", F.col("_metadata.file_path").alias("_file"))
        )
        text = ", ".join(f"`{name}` STRING" for name in [*header, _MISSHAPEN])
        cells = F.from_csv(_LINE, text, {**options, "columnNameOfCorruptRecord": _MISSHAPEN})
        dates = date_parsers(TIMESTAMP_COLUMNS[table], DATE_COLUMNS[table])
        unread = {c: F.col(c).isNotNull() & parsed.isNull() for c, parsed in dates.items()}
        numbers = [f.name for f in schema if not isinstance(f.dataType, StringType)]

        def rejects(cell: Column) -> Column:
            found = [_reject(c, F.col(c), is_bad) for c, is_bad in unread.items()]
            found += [_reject(c, cell[c], F.col(c).isNull() & cell[c].isNotNull()) for c in numbers]
            line = cell[_MISSHAPEN]
            return F.array(*found, _reject(None, line, line.isNotNull()))

        bad = reduce(Column.__or__, unread.values(), F.col(_LINE).isNotNull())
        # Inside a lambda the parse isn't pruned either.
        listed = F.flatten(F.transform(F.array(cells), rejects))
        parts.append(
            rows.where(bad).select(F.col("_file").alias("file"), F.inline(F.array_compact(listed)))
        )
    return reduce(DataFrame.unionByName, parts)
