"""Ordered rules as data: hundreds of sequential strict edits in one projection.

A rule edits one column where all its tests hold; a later rule sees what the earlier ones left. The
two-way choice is strict: a test on a missing value is unknown, and an unknown rule blanks its column
(``in`` and ``isna`` are never unknown, and a false test decides whatever the others are).

One projection per edit makes plans as deep as the rule list is long, and their generated methods too large for
the JVM to compile. Here the rules are an array of structs and a row's values are folded over it
(``aggregate`` with a struct as its state), so the plan's size depends on the number of columns, not of
rules.

Columns that every rule tests with ``==`` and none edits are keys: the rules of each key are an array of their own, found by a
hash join with the (broadcast) rule table, so a row only meets rules that can hold for it. A row with a missing key
meets all of them, as an unknown test may blank its values. Without keys, a row that no rule can change as it stands is left
alone by a flat condition, and only the others are folded.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import semantics as S

#: Most rules of a table (they are read by the driver and broadcast).
MAX_RULES = 100_000
#: Rules up to which a flat condition keeps untouched rows out of the fold.
FLAT_RULES = 40
_OPS = {"==": 1, "in": 2, "isna": 3}
#: Columns of a rule table: one row per test, rules in order of ``seq``; ``values`` and ``value`` as text.
RULE_SCHEMA = "seq int, target string, column string, op string, values array<string>, action string, value string"


@dataclass(frozen=True)
class Rule:
    """``target`` becomes ``value`` where all ``tests`` (column, '==' | 'in' | 'isna', value) hold. A pair as ``value``, (old, new), replaces
    one text by another within the column's value."""
    target: str
    tests: tuple
    value: object

    @property
    def replaces(self) -> bool:
        return isinstance(self.value, tuple)


def rules_of(table: DataFrame) -> list[Rule]:
    """Rules of a table of ``RULE_SCHEMA``; values stay text and are cast to their column's type when they are applied. ``action``:
    ``set`` or ``replace:<old>``. Fails on more than ``MAX_RULES`` tests or an unknown operation."""
    rows = table.select("seq", "target", "column", "op", "values", "action", "value").orderBy("seq", "column").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} tests in a rule table")
    by_seq: dict = {}
    for r in rows:
        by_seq.setdefault(r["seq"], []).append(r)
    out = []
    for tests in by_seq.values():
        first = tests[0]
        if any(t["op"] not in _OPS for t in tests):
            raise ValueError(f"rule {first['seq']}: unknown operation")
        kind, _, old = (first["action"] or "set").partition(":")
        value = (old, first["value"]) if kind == "replace" else first["value"]
        out.append(Rule(first["target"], tuple((t["column"], t["op"], list(t["values"]) if t["op"] == "in" else (t["values"] or [None])[0]) for t in tests), value))
    return out


def _plain(v, kind: T.DataType):
    """A value as JSON writes it for a column of ``kind``."""
    if v is None:
        return None
    if isinstance(kind, T.StringType):
        return str(v)
    if isinstance(kind, T.BooleanType):
        return v if isinstance(v, bool) else str(v).lower() == "true"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return int(v)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float(v)
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else str(v)


def key_columns(rules: Sequence[Rule]) -> list[str]:
    """Columns that every rule tests with ``==`` and none edits."""
    edited = {r.target for r in rules}
    common = reduce(lambda a, b: a & b, ({c for c, op, _ in r.tests if op == "=="} for r in rules))
    return list(dict.fromkeys(c for c, _, _ in rules[0].tests if c in common and c not in edited))


def _test(value: Column, op: str, given) -> Column:
    if op == "==":
        return value == F.lit(given)
    return S.is_in(value, given) if op == "in" else value.isNull()


def apply_rules(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str] | None = None) -> DataFrame:
    """``df`` with its columns edited by the rules, in order; the columns keep their places and types."""
    if not rules:
        return df
    keys = list(keys) if keys is not None else key_columns(rules)
    names = list(dict.fromkeys([c for r in rules for c in (r.target, *(t[0] for t in r.tests))]))
    number = {c: i for i, c in enumerate(names)}
    kinds = {c: df.schema[c].dataType for c in names}
    targets = list(dict.fromkeys(r.target for r in rules))
    tested = [c for c in names if any(c == t[0] for r in rules for t in r.tests) and c not in keys]

    def packed(r: Rule) -> dict:
        out: dict = {"t": number[r.target]}
        if r.replaces:
            out |= {"old": r.value[0], "new": r.value[1]}
        else:
            out[f"v{number[r.target]}"] = _plain(r.value, kinds[r.target])
        ops: dict[int, list] = {}
        for c, op, v in r.tests:
            ops.setdefault(number[c], []).append({"op": _OPS[op], "x": [_plain(x, kinds[c]) for x in (v if op == "in" else [v])]})
        return out | {f"c{i}": tests for i, tests in ops.items()}

    def ddl(kind: T.DataType) -> str:
        return kind.simpleString()

    fields = ["t int", "old string", "new string", *(f"v{number[c]} {ddl(kinds[c])}" for c in targets),
              *(f"c{number[c]} array<struct<op:int,x:array<{ddl(kinds[c])}>>>" for c in [*tested, *keys])]
    kind = f"array<struct<{','.join(f.replace(' ', ':', 1) for f in fields)}>>"
    all_rules = F.from_json(F.lit(json.dumps([packed(r) for r in rules])), kind)

    def holds(s: Column, r: Column) -> Column:
        """Whether a rule holds: the tests of all columns, three-valued."""
        def of_column(c: str) -> Column:
            v, tests = s[f"f{number[c]}"], r[f"c{number[c]}"]

            def one(t: Column) -> Column:
                known = F.when(t["op"] == 1, v == F.get(t["x"], 0)).when(t["op"] == 2, F.coalesce(F.array_contains(t["x"], v), F.lit(False)))
                return known.otherwise(v.isNull())
            return F.when(tests.isNull(), F.lit(True)).otherwise(F.forall(tests, one))
        return reduce(lambda a, b: a & b, [of_column(c) for c in [*tested, *keys]])

    def edit(s: Column, r: Column) -> Column:
        def edited(h: Column) -> Column:
            out = []
            for c in names:
                i, old = number[c], s[f"f{number[c]}"]
                if c in targets:
                    new = r[f"v{i}"]
                    if isinstance(kinds[c], T.StringType):
                        new = F.when(r["old"].isNotNull(), F.replace(old, r["old"], r["new"])).otherwise(new)
                    old = F.when(r["t"] != i, old).when(h.isNull(), F.lit(None)).when(h, new).otherwise(old)
                out.append(old.cast(kinds[c]).alias(f"f{i}"))
            return F.struct(*out)
        # the condition is worked out once per rule
        return F.get(F.transform(F.array(holds(s, r)), edited), 0)

    state = F.struct(*[F.col(f"`{c}`").alias(f"f{number[c]}") for c in names])

    def folded(given: Column) -> Column:
        return F.aggregate(given, state, edit)

    spare = "__rules"
    if keys:
        groups: dict[tuple, list[Rule]] = {}
        for r in rules:
            groups.setdefault(tuple(_plain(next(v for c, op, v in r.tests if c == k and op == "=="), kinds[k]) for k in keys), []).append(r)
        rows = [{**{f"k{i}": v for i, v in enumerate(k)}, spare: [packed(r) for r in g]} for k, g in groups.items() if None not in k]
        entry = ",".join([*(f"k{i}:{ddl(kinds[k])}" for i, k in enumerate(keys)), f"{spare}:{kind}"])
        # bounded by MAX_RULES; built in the JVM from one literal
        table = df.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{entry}>>")))
        same = reduce(lambda a, b: a & b, [F.col(f"`{k}`") == F.col(f"k{i}") for i, k in enumerate(keys)])
        unknown = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
        met = df.join(F.broadcast(table), same, "left")
        mine = F.when(unknown, all_rules).otherwise(F.col(spare))
        new = F.when(mine.isNotNull(), folded(mine)).otherwise(state)
    else:
        met = df
        new = folded(all_rules)
        if len(rules) <= FLAT_RULES:
            may = [reduce(lambda a, b: a & b, [_test(F.col(f"`{c}`"), op, v).cast("boolean") for c, op, v in r.tests]) for r in rules]
            idle = reduce(lambda a, b: a & b, [F.coalesce(~m, F.lit(False)) for m in may])
            new = F.when(idle, state).otherwise(new)
    out = met.withColumn("__state", new)
    return out.select(*[F.col("__state")[f"f{number[c]}"].alias(c) if c in targets else F.col(f"`{c}`") for c in df.columns])


def as_rules(table: Sequence[tuple[str, Sequence, object]]) -> list[Rule]:
    """Rules from (target, tests, value) rows."""
    return [Rule(t, tuple(tests), v) for t, tests, v in table]


def rule_rows(rules: Sequence[Rule]) -> list[tuple]:
    """Rows of ``RULE_SCHEMA`` for rules (the way back of :func:`rules_of`)."""
    def text(v):
        return None if v is None else str(v)
    return [(i, r.target, c, op, [text(x) for x in (v if op == "in" else [v])], f"replace:{r.value[0]}" if r.replaces else "set", text(r.value[1] if r.replaces else r.value))
            for i, r in enumerate(rules) for c, op, v in r.tests]


def as_edits(rules: Sequence[Rule]) -> list[tuple[str, Column, object]]:
    """The rules as single edits, one projection each (for comparison, and for a few rules on hot paths)."""
    out = []
    for r in rules:
        cond = reduce(lambda a, b: a & b, [_test(F.col(f"`{c}`"), op, v) for c, op, v in r.tests])
        out.append((r.target, cond, (lambda cur, v=r.value: F.replace(cur, F.lit(v[0]), F.lit(v[1]))) if r.replaces else F.lit(r.value)))
    return out
