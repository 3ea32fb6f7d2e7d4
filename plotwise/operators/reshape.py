"""Reshaping: column ranges, wide <-> long, unions by name, level grids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` inclusive, in schema order (driver
    reads the schema only)."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    if j < i:
        i, j = j, i
    return cols[i:j + 1]


def non_null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: the count of known values per column (one aggregation pass,
    partial counts per task)."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])


def known_counts(cols: Sequence[str]) -> dict[str, Column]:
    """The count of known values of each column, as aggregates."""
    return {c: F.count(F.col(f"`{c}`")) for c in cols}


def drop_all_null_columns(df: DataFrame, cols: Sequence[str] | None = None, counts: Mapping[str, int] | None = None) -> DataFrame:
    """Drop the columns (among ``cols``) that hold no known value.

    The column *set* depends on the data, so one single-row aggregate is
    read on the driver; no data rows are collected. ``counts``: the counts of
    known values where they were taken already (``session.stage_observed``).
    """
    cols = list(cols or df.columns)
    counts = counts if counts is not None else non_null_counts(df, cols).first().asDict()
    return df.drop(*[c for c in cols if counts[c] == 0])


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str],
            names_to: str = "name", values_to: str = "value",
            drop_na: bool = False) -> DataFrame:
    """Wide to long. Missing cells are kept unless ``drop_na``; the value
    columns must share one type (cast them first)."""
    q = lambda c: F.col(f"`{c}`")  # noqa: E731 - names may hold dots
    out = df.unpivot([q(c) for c in ids], [q(c) for c in values], names_to, values_to)
    if drop_na:
        out = out.filter(F.col(values_to).isNotNull())
    return out


def to_wide(df: DataFrame, names_from: str, values_from: str,
            levels: Sequence[str], ids: Sequence[str] | None = None) -> DataFrame:
    """Long to wide with an explicit level list (no extra job to discover
    levels). One aggregation on the id columns. A repeated row counts once; a
    cell with two different values (a missing one counts as a value) fails
    the job, it is never resolved silently."""
    ids = list(ids) if ids is not None else [c for c in df.columns if c not in (names_from, values_from)]
    v = F.col(f"`{values_from}`")
    # min = max over all rows of a cell: one pass, combined before the shuffle
    several = (F.min(v) != F.max(v)) | ((F.count(v) > 0) & (F.count(v) < F.count(F.lit(1))))
    cell = F.when(several, F.raise_error(F.lit(f"several values of {values_from} in one cell")).cast(df.schema[values_from].dataType))
    return df.groupBy(*ids).pivot(names_from, list(levels)).agg(cell.otherwise(F.min(v)))


def bind_rows(*dfs: DataFrame) -> DataFrame:
    """Union by column name; a column missing from an input is NULL there.
    Types are widened by Spark (date + timestamp -> timestamp)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def expand_levels(df: DataFrame, levels: Mapping[str, Sequence]) -> DataFrame:
    """Every row of ``df`` repeated for every combination of fixed level
    lists (a grid of the distinct rows of ``df`` by the levels).

    Written as ``explode`` of literal arrays, so the output grows linearly
    with ``df`` and nothing is paired row-by-row.
    """
    out = df.distinct()
    for name, vals in levels.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in vals])))
    return out

