"""Rescaling and imputation of repeated measurements.

All operators are aggregate-then-join plans: group statistics are reduced
with partial aggregation before any shuffle, and rows meet their group's
statistic through an equi-join (AQE broadcasts small statistic tables and
splits skewed partitions otherwise). Nothing pairs the rows of a group with
each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S
from . import joins
from .grouped import mean_of, sampling_index, sum_of

ADJACENT_FLAG = "Subturf w/o cover. Imputed as mean of adjacent years"


@dataclass(frozen=True)
class GateRule:
    """Rescale a whole group by ``factor`` when, on some row of ``recorder``,
    (group sum of that recorder's values) ``op`` ``threshold`` x total."""

    recorder: str
    op: str  # "<" or ">"
    threshold: float
    factor: float  # multiply by factor (use 1/x to divide)
    divide: bool = False


def _scale(v: Column, rule: GateRule) -> Column:
    return (v / F.lit(rule.factor)) if rule.divide else (v * F.lit(rule.factor))


def ratio_gated_rescale(df: DataFrame, keys: Sequence[str], value: str, recorder_col: str,
                        total_col: str, rules: Sequence[GateRule], joint_rules: int = 4) -> DataFrame:
    """Observer-bias fix: per group, the strict sum of one recorder's values
    relative to the row's reference total decides whether *all* rows of the
    group are rescaled. Rules run in order; each sees the previous result.

    The test "some row of the recorder has ``sum / total op threshold``" is
    written ``sum < threshold * max(total)`` (``>``: ``min``), which is the
    same decision for non-negative totals, including a zero total. A missing
    value among the recorder's rows makes the sum unknown and switches the
    rescale off.

    One aggregation pass computes, per group, every sum a later rule could
    need (one per on/off combination of the earlier gates, each summing the
    row values rescaled exactly as the sequential rules would); the gates are
    then decided on the small per-group table and joined back once. The
    number of sums doubles with each rule, so at most ``joint_rules`` rules
    share a pass; longer lists take one pass per ``joint_rules`` rules, with
    the same result.
    """
    keys = list(keys)
    rules = list(rules)
    if len(rules) > joint_rules:
        for i in range(0, len(rules), joint_rules):
            df = ratio_gated_rescale(df, keys, value, recorder_col, total_col, rules[i:i + joint_rules], joint_rules)
        return df
    v = F.col(value)
    aggs = []
    for i, r in enumerate(rules):
        is_rec = F.coalesce(F.col(recorder_col) == F.lit(r.recorder), F.lit(False))
        tot = F.max if r.op == "<" else F.min
        aggs += [F.count(F.when(is_rec, F.lit(1))).alias(f"__n{i}"),
                 F.count(F.when(is_rec, v)).alias(f"__nv{i}"),
                 tot(F.when(is_rec, F.col(total_col))).alias(f"__t{i}")]
        for combo in product((0, 1), repeat=i):
            sv = v
            for rj, bit in zip(rules, combo):
                sv = _scale(sv, rj) if bit else sv
            aggs.append(F.sum(F.when(is_rec, sv)).alias(f"__s{i}_{''.join(map(str, combo))}"))
    g = df.groupBy(*keys).agg(*aggs)
    for i, r in enumerate(rules):
        s_sel = None
        for combo in product((0, 1), repeat=i):
            name = F.col(f"__s{i}_{''.join(map(str, combo))}")
            cond = F.lit(True)
            for j, bit in enumerate(combo):
                cond = cond & (F.col(f"__g{j}") == F.lit(bool(bit)))
            s_sel = F.when(cond, name) if s_sel is None else s_sel.when(cond, name)
        thr = F.lit(r.threshold) * F.col(f"__t{i}")
        test = (s_sel < thr) if r.op == "<" else (s_sel > thr)
        strict = F.col(f"__nv{i}") == F.col(f"__n{i}")
        g = g.withColumn(f"__g{i}", F.coalesce(strict & test, F.lit(False)))
    gates = [f"__g{i}" for i in range(len(rules))]
    j = joins.join(df, g.select(*keys, *gates), keys, "left")
    out = v
    for i, r in enumerate(rules):
        out = F.when(F.coalesce(F.col(gates[i]), F.lit(False)), _scale(out, r)).otherwise(out)
    return j.withColumn(value, out).drop(*gates)


def mask_scale(df: DataFrame, value: str, mask: Column, factor: float) -> DataFrame:
    """Masked assignment ``x[mask] <- x[mask] * factor`` (unknown mask = no)."""
    v = F.col(value)
    return df.withColumn(value, F.when(F.coalesce(mask, F.lit(False)), v * F.lit(factor)).otherwise(v))


def adjacent_impute(df: DataFrame, unit: Sequence[str], item: Sequence[str], period: str,
                    value: str, presence: str | None, out_keys: Sequence[str],
                    missing: Column | None = None, distinct_neighbours: bool = False,
                    index: DataFrame | None = None, flag: str = ADJACENT_FLAG) -> DataFrame:
    """Mean of the two adjacent sampling occasions for missing values.

    * sampling index: rank of the distinct periods of each ``unit`` (from
      ``index`` if given, else from ``df``), so a skipped period still
      counts as adjacent;
    * missing rows: ``missing`` (default: ``presence`` known and ``value``
      missing);
    * neighbours: rows of the same unit + item with a known value at index
      +-1; exactly two neighbour rows are required, one or three and more
      give nothing.

    The neighbour side is reduced to (count, sum) per (unit, item, period)
    before the join, so each missing row probes two aggregated rows instead
    of pairing with every row of its unit.
    Returns ``out_keys`` + ``value`` + ``flag`` for the imputed keys.
    """
    unit, item, out_keys = list(unit), list(item), list(out_keys)
    if index is None:
        idx = sampling_index(df, unit, period, "__s")
    else:
        idx = index.withColumnRenamed("sampling", "__s")
    if missing is None:
        missing = F.col(presence).isNotNull() & F.col(value).isNull()
    # duplicated missing rows multiply the neighbour count, as a row-level
    # join would: keep their multiplicity instead of the rows
    miss = df.filter(missing).groupBy(*out_keys).agg(F.count(F.lit(1)).alias("__m"))
    miss = joins.join(miss, idx, unit + [period], "left")
    # the missing rows look up their neighbours' periods, so the known ones
    # (far more) are only shuffled by (unit, item, period), once
    probes = miss.withColumn("__nb", F.explode(F.array(F.col("__s") - 1, F.col("__s") + 1)))
    probes = joins.join(probes, idx.withColumnRenamed(period, "__period"), [*((u, u) for u in unit), ("__nb", "__s")], "inner")

    known = df.filter(F.col(value).isNotNull())
    if distinct_neighbours:
        known = known.select(*unit, *item, period, value).distinct()
    # reduce to (count, sum) per occasion first; equal structs hold equal or equally missing fields
    at = lambda p: F.struct(*[F.col(f"`{c}`") for c in [*unit, *item]], F.col(f"`{p}`").alias("__period")).alias("__at")
    nb = known.groupBy(at(period)).agg(F.count(F.lit(1)).alias("__n"), sum_of(df, value).alias("__sum"))
    m = probes.withColumn("__at", at("__period")).join(nb, "__at")
    res = (m.groupBy(*out_keys)
            .agg(F.max("__m").alias("__m"), F.sum("__n").alias("__n"), sum_of(m, "__sum").alias("__sum"))
            .filter(F.col("__m") * F.col("__n") == 2)
            .select(*out_keys, (F.col("__sum") / F.col("__n").cast("double")).alias(value),
                    F.lit(flag).alias("flag")))
    return res


def group_mean_impute(df: DataFrame, group: Sequence[str], value: str,
                      missing_keys: DataFrame) -> DataFrame:
    """Each missing key gets the mean of the known values of its group
    (computed on ``df`` as given, i.e. before any other imputation).

    Keys with no known value in their group keep a NULL value.
    """
    group = list(group)
    # all groups are averaged: partial means are combined before the shuffle, which finding the missing groups first would not spare
    means = df.groupBy(*group).agg(mean_of(df, value).alias(value))
    return joins.join(missing_keys, means, group, "left")


def apply_imputations(df: DataFrame, keys: Sequence[str], value: str,
                      *imputed: DataFrame, drop_missing: bool = True,
                      item: str | None = None, cells: str | None = None, blanks: str | None = None) -> DataFrame:
    """Patch ``value`` with each imputation table in order (each one's known
    value wins over the current one, so the *last* table takes precedence
    where several apply); then drop rows still missing.

    With ``cells``, ``df`` holds one row per unit and its items as an array of
    structs (``item``, ``value``, ...; ``item`` is one of ``keys``), ``blanks``
    the names of further items without a value (a JSON list): the tables (unique in
    ``keys``) are gathered per unit and met in one join.
    """
    keys = list(keys)
    if cells is not None:
        return _apply_to_cells(df, keys, value, imputed, item, cells, blanks)
    for t in imputed:
        df = joins.patch_join(df, t.select(*keys, value), keys, [value], "left")
    if drop_missing:
        df = df.filter(F.col(value).isNotNull())
    return df


def _apply_to_cells(df: DataFrame, keys: list[str], value: str, imputed: Sequence[DataFrame], item: str, cells: str, blanks: str) -> DataFrame:
    unit = [k for k in keys if k != item]
    given = reduce(DataFrame.unionByName, [
        t.filter(F.col(value).isNotNull()).select(*keys, F.struct(F.lit(i).alias("i"), F.col(value).alias("v")).alias("__v")) for i, t in enumerate(imputed)])
    given = given.groupBy(*unit).agg(F.collect_list(F.struct(F.col(item).alias("item"), F.col("__v"))).alias("__given"))
    j = joins.join(df, given, unit, "left")

    def of(i) -> Column:
        """The value of the last table that holds the item."""
        mine = F.transform(F.filter("__given", lambda g: g["item"].eqNullSafe(i)), lambda g: g["__v"])
        return F.array_max(mine)["v"]
    kind = df.schema[cells].dataType.elementType

    def patched(x: Column) -> Column:
        return x.withField(value, F.coalesce(of(x[item]), x[value]))

    def filled(b: Column) -> Column:
        return F.struct(*[{item: b, value: of(b)}.get(f.name, F.lit(0).cast(f.dataType)).alias(f.name) for f in kind.fields])
    known = lambda a: F.filter(a, lambda x: x[value].isNotNull())
    j = j.withColumn(cells, F.when(F.col("__given").isNull(), known(F.col(cells))).otherwise(
        known(F.concat(F.transform(cells, patched), F.transform(F.from_json(blanks, "array<string>"), filled)))))
    return j.drop("__given", blanks).filter(F.size(cells) > 0)


def lookup_fill(df: DataFrame, lookup: DataFrame, by, target: str, new_col: str,
                broadcast: bool = False) -> DataFrame:
    """Missing ``target`` takes the lookup's ``new_col`` (left join, so a
    duplicated lookup row duplicates the matching rows)."""
    j = joins.join(df, lookup, by, "left", broadcast=broadcast)
    return j.withColumn(target, S.if_else_na(F.col(target).isNull(), F.col(new_col), F.col(target))).drop(new_col)


def explode_lookup_fill(df: DataFrame, lookup: DataFrame, list_col: str, by: Sequence[str],
                        target: str, new_col: str, broadcast: bool = False) -> DataFrame:
    """Lookup rows that hold a list of key values are exploded to one row per
    value, then used as in :func:`lookup_fill`."""
    lk = lookup.withColumn(list_col, F.explode(F.col(list_col)))
    return lookup_fill(df, lk, list(by), target, new_col, broadcast=broadcast)
