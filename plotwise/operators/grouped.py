"""Grouped "mutate": attach a per-group aggregate to every row of the group.

A whole-group window (``agg().over(partitionBy(k))``) sends every row of a
group to one task; one hot group (say a third of all rows) would then sit in
one task. Here the aggregate is computed with ``groupBy`` (partial
aggregation before the shuffle, so a hot group costs one row per map task)
and joined back on the group keys with null-safe equality. AQE broadcasts the
aggregate when its measured size is small and otherwise plans a sort-merge
join whose skewed partitions it splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact as X
from ..functions import semantics as S
from . import joins


def mean_of(df: DataFrame, value: str) -> Column:
    """Mean of the known values; of doubles, whatever the order of the rows."""
    return X.mean_exact(value) if X.is_float(df.schema[value].dataType) else F.avg(value)


def sum_of(df: DataFrame, value: str) -> Column:
    """Sum of the known values; of doubles, whatever the order of the rows."""
    return X.sum_exact(value) if X.is_float(df.schema[value].dataType) else F.sum(value)


def strict_sum_of(df: DataFrame, value: str) -> Column:
    """Sum that is NULL when any value is; of doubles, whatever the order of the rows."""
    if not X.is_float(df.schema[value].dataType):
        return S.sum_strict(value)
    return F.when(F.count(value) == F.count(F.lit(1)), X.sum_exact(value))


def group_mutate(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], key_out: str | None = None) -> DataFrame:
    """Add one column per aggregate, computed over the row's group.

    Existing columns with the same names are replaced. ``key_out``: the keys
    stay on the rows as one struct of that name, by which the rows are dealt
    after the join: a later grouping that has it among its keys shuffles
    nothing (but one large group is then not split). Equal structs hold equal or equally missing fields.
    """
    keys = list(keys)
    base = df.drop(*[n for n in aggs if n in df.columns and n not in keys])
    if key_out is not None:
        key = F.struct(*[F.col(f"`{k}`") for k in keys]).alias(key_out)
        g = df.groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()])
        return base.withColumn(key_out, key).join(g, key_out, "left")
    g = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return joins.join(base, g, keys, "left")


def group_mean(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Mean of the known values of the group on every row (NULL if none)."""
    return group_mutate(df, keys, {out or value: mean_of(df, value)})


def group_sum_strict(df: DataFrame, keys: Sequence[str], value: str, out: str, key_out: str | None = None) -> DataFrame:
    """Group sum that is NULL when any value of the group is NULL."""
    return group_mutate(df, keys, {out: strict_sum_of(df, value)}, key_out)


def group_size(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Row count of the group on every row."""
    return group_mutate(df, keys, {out: F.count(F.lit(1))})


def targeted_group_sum(df: DataFrame, keys: Sequence[str], value: str, pred: Column,
                       key_pred: bool = False) -> DataFrame:
    """Replace ``value`` by its strict group sum on the rows where ``pred``
    holds (an unknown ``pred`` falls through); other rows keep their value.

    Only groups that contain a targeted row are aggregated. With
    ``key_pred=True`` the predicate must use key columns alone: targeted groups
    are then whole, and one filter replaces the search for them.
    """
    keys = list(keys)
    tmp = "__tgs"
    if key_pred:
        sums = df.filter(pred).groupBy(*keys).agg(strict_sum_of(df, value).alias(tmp))
        hit = F.coalesce(pred, F.lit(False))
        # only the targeted rows meet a sum; the rest is not shuffled
        out = joins.join(df.filter(hit), sums, keys, "left").withColumn(value, F.col(tmp)).drop(tmp)
        return df.filter(~hit).unionByName(out)
    flagged = df.withColumn("__pred", F.coalesce(pred, F.lit(False)))
    targets = flagged.filter("__pred").select(*keys).distinct()
    sums = (joins.semi_join(flagged, targets, keys)
            .groupBy(*keys).agg(strict_sum_of(df, value).alias(tmp)))
    j = joins.join(flagged, sums, keys, "left")
    return (j.withColumn(value, F.when(F.col("__pred"), F.col(tmp)).otherwise(F.col(value)))
             .drop(tmp, "__pred"))


def cover_over_time(df: DataFrame, keys: Sequence[str], value: str, n_out: str = "n_species", out: str = "total_cover") -> DataFrame:
    """Number of rows (species) and summed known cover of each unit and period."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n_out), sum_of(df, value).alias(out))


def first_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in the given total order (ties broken by
    the order columns only, so pass a unique tail for determinism).

    An aggregation (``min_by`` on a struct), so partial results are combined
    before the shuffle and a hot key never lands whole in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order_cols = [S.col(o) for o in order]
    ordk = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order_cols)])
    packed = F.struct(*[F.col(f"`{c}`") for c in rest])
    g = df.groupBy(*keys).agg(F.min_by(packed, ordk).alias("__row"))
    return g.select(*keys, *[F.col("__row").getField(c).alias(c) for c in rest]).select(*df.columns)


def sampling_index(df: DataFrame, unit: str | Sequence[str], period: str, out: str = "sampling") -> DataFrame:
    """Rank (1, 2, ...) of each distinct period within a unit, missing
    periods last. Returns one row per distinct (unit, period).

    The distinct step aggregates first, so the window only sees one row per
    period of a unit (a bounded, small set).
    """
    from pyspark.sql import Window
    units = [unit] if isinstance(unit, str) else list(unit)
    d = df.select(*units, period).distinct()
    w = Window.partitionBy(*units).orderBy(F.col(period).asc_nulls_last())
    return d.withColumn(out, F.row_number().over(w))


def pooled_mean_agg(values: Sequence[str]) -> Column:
    """Aggregate: mean over all rows *and* several columns, missing values
    removed (sum of every known value / number of known values)."""
    tot = sum((F.coalesce(F.col(v).cast("double"), F.lit(0.0)) for v in values[1:]),
              F.coalesce(F.col(values[0]).cast("double"), F.lit(0.0)))
    cnt = sum((F.col(v).isNotNull().cast("long") for v in values), F.lit(0))
    return F.try_divide(X.sum_exact(tot), F.sum(cnt).cast("double"))


def pooled_group_mean(df: DataFrame, keys: Sequence[str], values: Sequence[str], out: str,
                      extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Attach the pooled mean of several columns over the group (plus any
    ``extra`` group aggregates, computed in the same pass)."""
    return group_mutate(df, keys, {out: pooled_mean_agg(values), **(extra or {})})
