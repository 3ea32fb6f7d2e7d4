"""Column helpers that give Spark the missing-value rules of the survey scripts.

Spark's defaults differ from the data-frame semantics the survey cleaning
relies on in a few silent ways (an unknown condition in a two-way choice,
``NOT IN`` with a missing value, string building with a missing part, sums
that must become unknown when any input is unknown, ...). Each helper here
returns a plain ``Column`` built from built-in functions, so everything stays
inside whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _null() -> Column:
    return F.lit(None)


# --------------------------------------------------------------------------
# conditions
# --------------------------------------------------------------------------

def if_else_na(cond: Column, yes, no) -> Column:
    """Strict two-way choice: an unknown condition gives an unknown value.

    ``when(cond, a).otherwise(b)`` would take ``b`` for a NULL condition.
    """
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond.isNull(), _null()).when(cond, yes).otherwise(no)


def case_when(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """First-match rule list; an unknown condition falls through to the next branch."""
    out = None
    for cond, val in branches:
        val = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    if out is None:
        return default if isinstance(default, Column) else F.lit(default)
    if default is None:
        return out
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def is_in(c: ColumnOrName, values: Iterable) -> Column:
    """Membership that is never unknown: a missing value is in the list only
    if the list holds a missing value; otherwise it is simply not in it."""
    values = list(values)
    has_null = any(v is None for v in values)
    vals = [v for v in values if v is not None]
    c = col(c)
    test = F.coalesce(c.isin(vals), F.lit(False)) if vals else F.lit(False)
    return (test | c.isNull()) if has_null else test


def not_in(c: ColumnOrName, values: Iterable) -> Column:
    """Negated :func:`is_in`: keeps rows whose value is missing."""
    return ~is_in(c, values)


def matches(c: ColumnOrName, pattern: str) -> Column:
    """Regex test that is FALSE (never unknown) on a missing value, so its
    negation keeps rows with a missing value."""
    return F.coalesce(col(c).rlike(pattern), F.lit(False))


def detect(c: ColumnOrName, pattern: str) -> Column:
    """Regex test that stays unknown on a missing value."""
    return col(c).rlike(pattern)


def detect_fixed(c: ColumnOrName, text: str) -> Column:
    """Literal substring test that stays unknown on a missing value."""
    return col(c).contains(text)


# --------------------------------------------------------------------------
# aggregates (also usable over a window: pass ``w``)
# --------------------------------------------------------------------------

def _over(c: Column, w: WindowSpec | None) -> Column:
    return c.over(w) if w is not None else c


def sum_strict(c: ColumnOrName, w: WindowSpec | None = None, where: Column | None = None) -> Column:
    """Sum that is unknown when any summed value is unknown.

    ``where`` restricts the rows taken into the sum (and into the
    strictness test) without filtering the frame.
    """
    c = col(c)
    if where is not None:
        c = F.when(where, c)
        n_rows = F.count(F.when(where, F.lit(1)))
    else:
        n_rows = F.count(F.lit(1))
    return F.when(_over(F.count(c), w) == _over(n_rows, w), _over(F.sum(c), w))


def mean_strict(c: ColumnOrName, w: WindowSpec | None = None) -> Column:
    """Mean that is unknown when any value is unknown."""
    c = col(c)
    return F.when(_over(F.count(c), w) == _over(F.count(F.lit(1)), w), _over(F.avg(c), w))


def mean_na_rm(c: ColumnOrName, w: WindowSpec | None = None) -> Column:
    """Mean of the known values; no known value gives NULL (NaN in the
    scripts: both are "missing" downstream)."""
    return _over(F.avg(col(c)), w)


def n_distinct(c: ColumnOrName) -> Column:
    """Distinct count in which a missing value counts as one more value."""
    c = col(c)
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


# --------------------------------------------------------------------------
# conversions and text
# --------------------------------------------------------------------------

def in_order(df: DataFrame, c: str, collation: str | None) -> Column:
    """The column, a text one in the order of a locale (a collation name such
    as ``"nb"``) where one is given; else binary order."""
    text = isinstance(df.schema[c].dataType, T.StringType)
    return F.collate(F.col(f"`{c}`"), collation) if collation and text else F.col(f"`{c}`")


def plain_text(c: Column) -> Column:
    """The value as text without a collation of its own."""
    return F.collate(c.cast("string"), "UTF8_BINARY")


NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?)\s*$"


def to_num(c: ColumnOrName) -> Column:
    """Text to number; unparseable text becomes NULL instead of failing the
    job, and NaN is treated as missing. Only plain decimal or exponent
    notation (or infinity) counts as a number: a type suffix (``5d``) does not."""
    text = col(c).cast("string")
    v = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(~F.isnan(v), v)


def to_num_comma(c: ColumnOrName) -> Column:
    """Text with a decimal comma to number (``'1,5'`` -> 1.5)."""
    return to_num(F.regexp_replace(col(c).cast("string"), ",", "."))


def r_str(c: ColumnOrName) -> Column:
    """Render a number as text the way the scripts do: whole doubles print
    without a trailing ``.0`` (``4`` not ``4.0``)."""
    c = col(c)
    whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e15))
    return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def paste(*parts: ColumnOrName | str, sep: str = "", literal: bool = False) -> Column:
    """String building where a missing part is written ``NA`` and a whole
    double is written without its decimals (a block read as 1.0 gives ``1``).

    Plain ``str`` arguments are column names unless ``literal=True``; use
    ``F.lit`` for literal text mixed with columns.
    """
    cols = []
    for p in parts:
        if isinstance(p, str):
            p = F.lit(p) if literal else F.col(p)
        # typeof is folded when the plan is optimised: text parts keep their text
        number = F.typeof(p).isin("double", "float")
        text = F.when(number, r_str(p.cast("string").try_cast("double"))).otherwise(p.cast("string"))
        cols.append(F.coalesce(text, F.lit("NA")))
    if sep:
        return F.concat_ws(sep, *cols)
    return F.concat(*cols)


def na_text_to_null(c: ColumnOrName) -> Column:
    """Delimited-text readers that treat the text ``NA`` as missing."""
    return F.nullif(col(c), F.lit("NA"))


def base_text_missing(c: ColumnOrName) -> Column:
    """Base-R reader convention for text columns: blank stays ``''`` and the
    text ``NA`` is missing."""
    c = col(c)
    return F.when(c.isNull(), F.lit("")).when(c != F.lit("NA"), c)


def r_substr(c: ColumnOrName, start: int, stop: int | Column) -> Column:
    """1-based inclusive substring ``[start, stop]``."""
    c = col(c)
    if isinstance(stop, Column):
        length = F.greatest(stop - F.lit(start) + F.lit(1), F.lit(0))
        return F.substring(c, F.lit(start), length)
    return F.substring(c, start, max(stop - start + 1, 0))


def str_sub_from(c: ColumnOrName, start: int) -> Column:
    """From ``start`` to the end; a negative start counts from the end."""
    c = col(c)
    if start < 0:
        return F.substring(c, start, -start)
    return F.substring(c, start, 2147483647)


def recode(c: ColumnOrName, mapping: Mapping, default: Column | None = None) -> Column:
    """Value replacement from a fixed, small map; unmatched values are kept
    (or replaced by ``default``). For data-sized maps use a lookup join."""
    c = col(c)
    if not mapping:
        return c if default is None else default
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), c if default is None else default)


def row_mean(*cols: ColumnOrName) -> Column:
    """Mean across columns of one row, ignoring missing values; NULL when
    all are missing. Plain arithmetic (no lambda functions), so it stays in
    generated code."""
    vals = [col(c).cast("double") for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in vals])
    known = reduce(lambda a, b: a + b, [v.isNotNull().cast("int") for v in vals])
    return F.try_divide(total, known.cast("double"))


def logit(p: ColumnOrName) -> Column:
    """log(p / (1 - p)); NULL outside the open interval (0, 1)."""
    p = col(p)
    return F.when((p > 0) & (p < 1), F.ln(p / (F.lit(1.0) - p)))


def level_rank(c: ColumnOrName, levels: Sequence[str]) -> Column:
    """Position (1-based) of a value in an ordered level list; values outside
    the levels (and missing values) give NULL, as a factor would."""
    m = F.create_map(*[F.lit(x) for i, lv in enumerate(levels) for x in (lv, i + 1)])
    return F.try_element_at(m, col(c))

