"""Quality checks, level listings and the data dictionary.

Checks return their violations as rows (a DataFrame), never print or
collect; an empty result means the check passed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import semantics as S
from . import joins
from .grouped import group_mutate
from ..sources.inline import inline_table


def duplicate_value_check(df: DataFrame, keys: Sequence[str], value: str, out: str = "n") -> DataFrame:
    """Keys holding more than one distinct value (a missing value counts as
    a value)."""
    return df.groupBy(*keys).agg(S.n_distinct(value).alias(out)).filter(F.col(out) > 1)


def unique_key_violations(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """All rows whose key occurs more than once, with the key's row count."""
    return group_mutate(df, keys, {out: F.count(F.lit(1))}).filter(F.col(out) > 1)


def completeness_check(df: DataFrame, keys: Sequence[str], expected: int, out: str = "n") -> DataFrame:
    """Keys with fewer rows than expected."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) < expected)


def missing_listing(df: DataFrame, value: str, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Distinct keys whose ``value`` is missing (optionally among rows where
    ``where`` holds)."""
    cond = F.col(value).isNull()
    if where is not None:
        cond = cond & where
    return df.filter(cond).select(*keys).distinct()


@dataclass(frozen=True)
class Check:
    """A rule on the rows of each key: ``unique`` (one row), ``complete`` (``expected`` rows at least), ``one value`` (of ``value``; a
    missing one counts as a value) or ``known`` (no ``value`` missing, among the rows where ``where`` holds)."""
    name: str
    kind: str
    keys: tuple
    value: str | None = None
    expected: int | None = None
    where: Column | None = None


def violations(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check, keys, n): the keys that break a rule, for all rules in one aggregation with GROUPING SETS, one set for each
    list of keys, so the table is read and shuffled once. ``keys`` is a text (``name=value;...``, a missing value
    as ``NA``); ``n``: rows of the key, for ``known`` those without a value."""
    kinds = ("unique", "complete", "one value", "known")
    for c in checks:
        if c.kind not in kinds:
            raise ValueError(f"{c.name}: unknown kind {c.kind!r}")
    cols = list(dict.fromkeys(k for c in checks for k in c.keys))
    sets = list(dict.fromkeys(tuple(c.keys) for c in checks))
    values = list(dict.fromkeys(c.value for c in checks if c.value))
    read = list(dict.fromkeys([*cols, *values]))
    flags = {f"__w{i}": F.coalesce(c.where, F.lit(False)) for i, c in enumerate(checks) if c.where is not None}
    # values keep their own columns: a grouped key is NULL outside its sets
    given = df.select(*[F.col(f"`{c}`") for c in read], *[F.col(f"`{v}`").alias(f"__v{i}") for i, v in enumerate(values)], *[w.alias(n) for n, w in flags.items()])
    at = {v: f"__v{i}" for i, v in enumerate(values)}
    rows, aggs = F.count(F.lit(1)), {}
    for i, c in enumerate(checks):
        if c.kind == "one value":
            v = F.col(at[c.value])
            aggs[f"__c{i}"] = F.coalesce(F.min(v) != F.max(v), F.lit(False)) | ((F.count(v) > 0) & (F.count(v) < rows))
        elif c.kind == "known":
            missing = F.col(at[c.value]).isNull()
            aggs[f"__c{i}"] = F.count(F.when(missing & F.col(f"__w{i}") if c.where is not None else missing, F.lit(1)))
    grouped = given.groupingSets([[F.col(f"`{k}`") for k in s] for s in sets], *[F.col(f"`{k}`") for k in cols]).agg(
        F.grouping_id().alias("__set"), rows.alias("__n"), *[a.alias(n) for n, a in aggs.items()])
    out = []
    for i, c in enumerate(checks):
        number = sum(1 << (len(cols) - 1 - k) for k, name in enumerate(cols) if name not in c.keys)
        n = F.col(f"__c{i}") if c.kind == "known" else F.col("__n")
        broken = {"unique": F.col("__n") > 1, "complete": F.col("__n") < F.lit(c.expected), "one value": F.col(f"__c{i}") if c.kind == "one value" else None,
                  "known": F.col(f"__c{i}") > 0 if c.kind == "known" else None}[c.kind]
        keys = F.concat_ws(";", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("NA"))) for k in c.keys])
        out.append(F.when((F.col("__set") == number) & broken, F.struct(F.lit(c.name).alias("check"), keys.alias("keys"), n.cast("long").alias("n"))))
    return grouped.select(F.explode(F.filter(F.array(*out), lambda x: x.isNotNull())).alias("v")).select("v.check", "v.keys", "v.n")


def distinct_levels(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct values (or value combinations) of the given columns."""
    return df.select(*cols).distinct()


def preview(df: DataFrame, order: Sequence[str], n: int = 6, collation: str | None = None) -> DataFrame:
    """First ``n`` rows in a given order (a top-n: each task keeps n rows);
    texts in the order of ``collation``, if given."""
    return df.orderBy(*[S.in_order(df, c, collation).asc_nulls_last() for c in order]).limit(n)


def sorted_rows(df: DataFrame, order: Sequence[str], collation: str | None = None) -> DataFrame:
    """Rows sorted for a listing or a sink (range partitioned, in parallel);
    texts in the order of ``collation``, if given."""
    return df.orderBy(*[S.in_order(df, c, collation).asc_nulls_last() for c in order])


def text_range(df: DataFrame, keys: Sequence[str], value: str, collation: str | None = None) -> DataFrame:
    """First and last text of each key (``first``, ``last``), in the order of ``collation``, if given."""
    v = S.in_order(df, value, collation)
    return df.groupBy(*keys).agg(S.plain_text(F.min(v)).alias("first"), S.plain_text(F.max(v)).alias("last"))


def logit_histogram(df: DataFrame, value: str, lo: float, hi: float, bins: int,
                    bucket: str = "bucket", out: str = "n") -> DataFrame:
    """Histogram counts of logit(value) over ``bins`` equal-width buckets of
    [lo, hi) (0 = below, bins + 1 = at or above). Values outside (0, 1) have
    no finite logit and, as in a histogram of the scripts, are left out."""
    lg = S.logit(value)
    b = F.width_bucket(lg, F.lit(lo), F.lit(hi), F.lit(bins))
    return (df.select(lg.alias("__lg"), b.alias(bucket)).filter(F.col("__lg").isNotNull())
            .groupBy(bucket).agg(F.count(F.lit(1)).alias(out)))


# --------------------------------------------------------------------------
# data dictionary
# --------------------------------------------------------------------------

VAR = "Variable name"
VTYPE = "Variable type"
VRANGE = "Variable range or levels"
DICT_COLUMNS = ["TableID", VAR, "Description", VTYPE, VRANGE, "Units/treatment level", "How measured"]


def _classes(dt: T.DataType) -> list[str]:
    """The class names a column of this type has in the survey scripts'
    data frames (a date-time column has two)."""
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return ["character"]
    if isinstance(dt, T.BooleanType):
        return ["logical"]
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType)):
        return ["integer"]
    if isinstance(dt, (T.LongType, T.FloatType, T.DoubleType, T.DecimalType)):
        return ["numeric"]
    if isinstance(dt, T.DateType):
        return ["Date"]
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return ["POSIXct", "POSIXt"]
    return [dt.simpleString()]


_TYPE_NAME = {"character": "categorical", "logical": "categorical",
              "integer": "numeric", "numeric": "numeric", "Date": "date"}
_RANGED = ("character", "integer", "numeric", "Date")


def data_dictionary(data: DataFrame, descriptions: DataFrame, table_id: str,
                    keep_table_id: bool = False, collation: str | None = None) -> DataFrame:
    """Describe every column of ``data``. Ranges of text columns are in binary
    order or, with ``collation``, in that of a locale (``"nb"``).

    * type from the column's class (text/logical -> categorical,
      integer/numeric -> numeric, date -> date, anything else NULL; a
      date-time column yields one row per class, both with NULL type);
    * range ``"min - max"`` for text, numeric and date columns, computed in
      one aggregation pass over ``data`` and turned into rows with
      ``unpivot`` (no collect); a column without a known value has no range
      (NULL);
    * descriptions: general rows (``TableID`` NULL) joined on the variable
      name, plus rows specific to ``table_id`` joined on name and table.
    """
    spark: SparkSession = data.sparkSession
    fields = data.schema.fields
    ranged = [f.name for f in fields if _classes(f.dataType)[0] in _RANGED]
    if ranged:
        rng = data.agg(*[
            F.concat(S.plain_text(F.min(S.in_order(data, c, collation))), F.lit(" - "), S.plain_text(F.max(S.in_order(data, c, collation)))).alias(c)
            for c in ranged])
        rng = rng.unpivot([], [F.col(f"`{c}`") for c in ranged], VAR, VRANGE)
    else:
        rng = inline_table(spark, [], f"`{VAR}` string, `{VRANGE}` string")

    rows = [(f.name, _TYPE_NAME.get(k), table_id) for f in fields for k in _classes(f.dataType)]
    cls = inline_table(spark, rows, f"`{VAR}` string, `{VTYPE}` string, TableID string")
    cls = joins.join(cls, rng, VAR, "left")

    d = descriptions
    general = d.filter(F.col("TableID").isNull()).drop("TableID")
    special = d.filter(F.col("TableID").isNotNull() & (F.col("TableID") == F.lit(table_id)))
    out = (joins.join(cls, general, VAR, "inner")
           .unionByName(joins.join(cls, special, [VAR, "TableID"], "inner"), allowMissingColumns=True))
    out = out.select(*[F.col(f"`{c}`") for c in DICT_COLUMNS])
    return out if keep_table_id else out.drop("TableID")
