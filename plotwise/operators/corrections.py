"""Correction rules held as data or as ordered rule lists.

Two rule modes exist in the survey scripts:

* ``ordered`` - a sequence of strict two-way edits; each edit sees the
  result of the previous ones and an unknown condition blanks the value;
* ``first_match`` - a first-match rule list; an unknown condition falls
  through to the next rule.

Point corrections keyed by (unit, period[, species]) are kept as a table and
applied with a lookup join, so thousands of fixes cost one join instead of a
deep expression tree.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S
from . import joins, reshape

Rule = tuple[Column | Callable[[Column], Column], object]


def _cond(c, cur: Column) -> Column:
    return c(cur) if callable(c) else c


def apply_ordered(df: DataFrame, target: str, rules: Sequence[Rule]) -> DataFrame:
    """Strict ordered edits on one column.

    A condition may be a callable of the column's *current* value, so a later
    edit tests the value left by an earlier one. One projection per edit: a
    nested expression would repeat the current value and grow exponentially.
    """
    for cond, val in rules:
        cur = F.col(f"`{target}`")
        v = val(cur) if callable(val) else val
        df = df.withColumn(target, S.if_else_na(_cond(cond, cur), v, cur))
    return df


def apply_ordered_many(df: DataFrame, edits: Sequence[tuple[str, Column | Callable, object]]) -> DataFrame:
    """Ordered edits over several columns: ``(target, condition, value)``.
    Conditions written with ``F.col`` see the values left by earlier edits."""
    for target, cond, val in edits:
        cur = F.col(f"`{target}`")
        v = val(cur) if callable(val) else val
        df = df.withColumn(target, S.if_else_na(_cond(cond, cur), v, cur))
    return df


def apply_first_match(df: DataFrame, target: str, rules: Sequence[tuple[Column, object]]) -> DataFrame:
    """First-match rule list; unmatched rows keep their value."""
    return df.withColumn(target, S.case_when(list(rules), default=F.col(f"`{target}`")))


def point_corrections(df: DataFrame, fixes: DataFrame, keys: Sequence[str],
                      columns: Sequence[str], column_col: str = "column",
                      value_col: str = "value", broadcast: bool = False) -> DataFrame:
    """Apply a correction table ``(keys..., column, value)``: a fix replaces
    the value of ``column`` on matching rows, even a known one.

    The table is pivoted to one fix column per target (explicit level list)
    and left-joined on the keys with null-safe equality. Two different fixes
    for one (key, column) fail the job; a repeated one counts once.
    ``broadcast`` is for rule tables of bounded size.
    """
    keys, columns = list(keys), list(columns)
    wide = reshape.to_wide(fixes.select(*keys, column_col, value_col), column_col, value_col, columns, ids=keys)
    wide = wide.select(*keys, *[F.col(f"`{c}`").alias(f"__fix_{c}") for c in columns])
    j = joins.join(df, wide, keys, "left", broadcast=broadcast)
    out = j.withColumns({c: F.coalesce(F.col(f"__fix_{c}").cast(df.schema[c].dataType), F.col(f"`{c}`"))
                         for c in columns})
    return out.drop(*[f"__fix_{c}" for c in columns])


def dictionary_override(df: DataFrame, keyed: DataFrame, keys: Sequence[str | tuple[str, str]],
                        name_col: str, value_col: str | None, global_map: DataFrame | None,
                        new_name: str = "new", new_value: str | None = None,
                        old_name: str = "old", broadcast: bool = False) -> DataFrame:
    """Two-stage name override.

    (a) keyed: rows matching ``keys`` (which include the current name) take
        the dictionary's name and, if given, its value; the dictionary wins.
    (b) global: the (possibly renamed) name is mapped ``old -> new``.
    Missing keys match missing keys in both stages.
    """
    pay = [new_name] + ([new_value] if new_value else [])
    keyed_cols = [k if isinstance(k, str) else k[1] for k in keys]
    kd = keyed.select(*keyed_cols, *pay).withColumnsRenamed({new_name: "__new_name", **({new_value: "__new_val"} if new_value else {})})
    j = joins.join(df, kd, keys, "left", broadcast=broadcast)
    j = j.withColumn(name_col, F.coalesce(F.col("__new_name"), F.col(name_col)))
    if new_value and value_col:
        j = j.withColumn(value_col, F.coalesce(F.col("__new_val"), F.col(value_col)))
    j = j.drop("__new_name", "__new_val")
    if global_map is None:
        return j
    g = global_map.select(F.col(old_name).alias("__old"), F.col(new_name).alias("__gnew"))
    j2 = joins.join(j, g, [(name_col, "__old")], "left", broadcast=broadcast)
    return (j2.withColumn(name_col, S.if_else_na(F.col("__gnew").isNotNull(), F.col("__gnew"), F.col(name_col)))
              .drop("__gnew"))


def coalesce_blank(df: DataFrame, target: str, fallback: str | Column, missing_label: str | None = None,
                   label_col: str | None = None) -> DataFrame:
    """A blank or missing label takes the fallback column's value; optionally
    a missing ``label_col`` gets ``missing_label``."""
    fb = S.col(fallback)
    cur = F.col(target)
    out = df.withColumn(target, F.when(cur.isNull() | (cur == F.lit("")), fb).otherwise(cur))
    if label_col and missing_label is not None:
        out = out.withColumn(label_col, F.coalesce(F.col(label_col), F.lit(missing_label)))
    return out


def carry_rows_forward(df: DataFrame, select: Column, period_col: str, new_period) -> DataFrame:
    """Copy the rows matching ``select`` into another period and append them."""
    copied = df.filter(select).withColumn(
        period_col, F.lit(new_period).cast(df.schema[period_col].dataType))
    return df.unionByName(copied)


def normalise_names(c: Column | str, separators: str = "[ _]", to: str = ".") -> Column:
    """Separators (space, underscore) in a name become ``to``."""
    return F.regexp_replace(S.col(c), separators, to)


def class_rollup(df: DataFrame, traits: DataFrame, key: str, trait_key: str, trait_col: str, out: str,
                 merge_patterns: Mapping[str, str] | None = None,
                 key_overrides: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Attach a class from a trait table and roll it up.

    ``merge_patterns``: regex -> class, tested in order on the trait (a
    missing trait matches nothing); ``key_overrides``: class -> keys that get
    that class whatever their trait (tested in order).
    """
    t = traits.select(F.col(trait_key).alias("__k"), F.col(trait_col).alias(out))
    j = joins.join(df, t, [(key, "__k")], "left")
    cls = F.col(out)
    for pat, target in reversed(list((merge_patterns or {}).items())):
        cls = S.if_else_na(S.matches(F.col(out), pat), F.lit(target), cls)
    j = j.withColumn(out, cls)
    ov = F.col(out)
    for target, keys_ in reversed(list((key_overrides or {}).items())):
        ov = S.if_else_na(S.is_in(key, keys_), F.lit(target), ov)
    return j.withColumn(out, ov)


def presence_join(cover: DataFrame, marks: DataFrame, keys: Sequence[str], out: str = "presence") -> DataFrame:
    """Left join of cover rows to presence marks: a cover row is repeated for
    every mark of its keys (``out`` is 1.0 there, NULL without a mark).

    Marks are counted per key first, and each cover row is repeated that
    often, so a key of many marks is one row in the join.
    """
    counts = marks.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    j = joins.join(cover, counts, list(keys), "left")
    j = j.withColumn(out, F.when(F.col("__n").isNotNull(), F.lit(1.0)))
    times = F.array_repeat(F.lit(1), F.coalesce(F.col("__n"), F.lit(1)).cast("int"))
    return j.withColumn("__n", F.explode(times)).drop("__n")


def rebuild_ids(df: DataFrame, id_col: str, site_col: str, keep_pattern: str,
                strip: int = 3, stop: int | None = None) -> DataFrame:
    """Rebuild unit ids: unless the id matches ``keep_pattern``, drop its
    first ``strip`` characters; then prefix the site's 3-letter code.

    The scripts cut with ``substring(id, strip + 1, n())`` where ``n()`` is
    the frame's row count, i.e. "to the end" whenever the frame has at least
    as many rows as an id has characters; pass ``stop`` to reproduce a
    specific end.
    """
    cur = F.col(id_col)
    if stop is None:
        cut = F.substring(cur, strip + 1, 2147483647)
    else:
        cut = S.r_substr(cur, strip + 1, stop)
    out = df.withColumn(id_col, S.if_else_na(S.matches(cur, keep_pattern), cur, cut))
    return out.withColumn(id_col, S.paste(S.r_substr(site_col, 1, 3), F.col(id_col)))


def paired_zero_fill(df: DataFrame, a: str, b: str, total: str) -> DataFrame:
    """If one of a pair of components is known the other becomes 0; a missing
    total becomes the sum of the pair (sequential: each step sees the last)."""
    df = df.withColumn(a, F.when(F.col(b).isNotNull() & F.col(a).isNull(), F.lit(0.0)).otherwise(F.col(a)))
    df = df.withColumn(b, F.when(F.col(a).isNotNull() & F.col(b).isNull(), F.lit(0.0)).otherwise(F.col(b)))
    return df.withColumn(total, S.if_else_na(F.col(total).isNull(), F.col(b) + F.col(a), F.col(total)))


def total_fallback(df: DataFrame, ids: Sequence[str], totals: Sequence[str], fallback: str) -> DataFrame:
    """Group totals that are missing take the summed cover ``fallback`` (one
    of ``ids``): long, filled, and spread again, one row for each distinct
    ``ids``; two values in one cell fail the job."""
    long = reshape.to_long(df, ids, totals, "__total", "__cover")
    filled = long.withColumn("__cover", S.if_else_na(F.col("__cover").isNull(), F.col(f"`{fallback}`"), F.col("__cover")))
    return reshape.to_wide(filled, "__total", "__cover", totals, ids=ids)


def decimal_repair(c: Column | str, limit: float, divisor: float = 100.0) -> Column:
    """Values above a plausibility limit lost their decimal comma: divide."""
    c = S.col(c)
    return F.when(c > F.lit(limit), c / F.lit(divisor)).otherwise(c)
