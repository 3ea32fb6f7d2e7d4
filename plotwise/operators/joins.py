"""Joins with the survey scripts' key rules.

* missing keys match missing keys (null-safe equality, which Spark still
  plans as an equi-join: hash or sort-merge on ``coalesce(k, 0), isnull(k)``);
* ``by=None`` joins on every shared column name (natural join);
* clashing columns get suffixes, except the left keys, which keep their name
  (a right payload column named like a left key is suffixed);
* outer joins return one coalesced key column.

No strategy is forced: Spark/AQE picks broadcast-hash when the runtime size
of a side is under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to
sort-merge (with skewed partitions split by AQE) beyond it. ``broadcast=True``
is for lookup tables whose size is fixed by construction (inline dictionaries,
rule tables, tables restricted to such a dictionary), never for tables that
grow with the data. A full join with ``broadcast=True`` never shuffles the
left side (left join + the right rows nothing matched).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Keys = Sequence[str | tuple[str, str]] | str | None

_HOW = {
    "inner": "inner", "left": "left", "right": "right", "full": "full",
    "outer": "full", "semi": "left_semi", "left_semi": "left_semi",
    "anti": "left_anti", "left_anti": "left_anti",
}


def key_pairs(left: DataFrame, right: DataFrame, by: Keys) -> list[tuple[str, str]]:
    """Normalise ``by`` to (left name, right name) pairs; ``None`` = shared names."""
    if by is None:
        rset = set(right.columns)
        pairs = [(c, c) for c in left.columns if c in rset]
        if not pairs:
            raise ValueError("natural join: no shared column names")
        return pairs
    if isinstance(by, str):
        by = [by]
    return [(b, b) if isinstance(b, str) else (b[0], b[1]) for b in by]


def join(left: DataFrame, right: DataFrame, by: Keys = None, how: str = "left",
         suffix: tuple[str, str] = (".x", ".y"), broadcast: bool = False) -> DataFrame:
    """Data-frame style join: null-safe keys, suffixes on clashing payload,
    coalesced keys for outer joins.

    Output columns: left columns in order (keys keep the left name), then
    right payload columns in order.
    """
    how_spark = _HOW[how]
    pairs = key_pairs(left, right, by)
    lkeys = [a for a, _ in pairs]
    rkeys = [b for _, b in pairs]

    # private names for every right column so nothing is ambiguous
    rmap = {c: f"__r{i}" for i, c in enumerate(right.columns)}
    r = right.select([F.col(f"`{c}`").alias(t) for c, t in rmap.items()])
    if broadcast:
        r = F.broadcast(r)
    cond = None
    for a, b in pairs:
        e = F.col(f"`{a}`").eqNullSafe(F.col(rmap[b]))
        cond = e if cond is None else cond & e

    if how_spark == "full" and broadcast:
        # full join with a right side of bounded size: the left side is never
        # shuffled. Left rows meet the broadcast right side in a left join; the
        # right rows no left row matched are found by probing the left side
        # with the (broadcast) right keys and appended with missing left columns.
        rkey_cols = [rmap[b] for b in rkeys]
        matched = (left.join(F.broadcast(r.select(*rkey_cols).distinct()), cond, "left_semi")
                   .select(*[F.col(f"`{a}`").alias(rmap[b]) for a, b in pairs]).distinct())
        unmatched = _anti_on(r, matched, rkey_cols)
        lj = left.join(r, cond, "left")
        extra = unmatched.select(*[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns],
                                 *[F.col(c) for c in r.columns])
        joined = lj.unionByName(extra)
    else:
        joined = left.join(r, cond, how_spark)
    if how_spark in ("left_semi", "left_anti"):
        return joined

    rpay = [c for c in right.columns if c not in set(rkeys)]
    lall = set(left.columns)  # a right payload clashing with any left name (key or not) is suffixed
    rset = set(rpay)
    out = []
    for c in left.columns:
        if c in lkeys:
            rk = rmap[rkeys[lkeys.index(c)]]
            if how_spark in ("right", "full"):
                out.append(F.coalesce(F.col(f"`{c}`"), F.col(rk)).alias(c))
            else:
                out.append(F.col(f"`{c}`"))
        else:
            name = c + suffix[0] if c in rset else c
            out.append(F.col(f"`{c}`").alias(name))
    for c in rpay:
        name = c + suffix[1] if c in lall else c
        out.append(F.col(rmap[c]).alias(name))
    return joined.select(out)


def _anti_on(r: DataFrame, matched: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of ``r`` whose key columns (null-safe) are not in ``matched``."""
    m = matched.select(*[F.col(c).alias(f"__m{i}") for i, c in enumerate(cols)])
    cond = None
    for i, c in enumerate(cols):
        e = F.col(c).eqNullSafe(F.col(f"__m{i}"))
        cond = e if cond is None else cond & e
    return r.join(F.broadcast(m), cond, "left_anti")


def natural_join(left: DataFrame, right: DataFrame, how: str = "left", **kw) -> DataFrame:
    return join(left, right, None, how, **kw)


def semi_join(left: DataFrame, right: DataFrame, by: Keys = None, broadcast: bool = False) -> DataFrame:
    """Rows of ``left`` with a (null-safe) match in ``right``; never duplicates."""
    return join(left, right, by, "semi", broadcast=broadcast)


def anti_join(left: DataFrame, right: DataFrame, by: Keys = None, broadcast: bool = False) -> DataFrame:
    return join(left, right, by, "anti", broadcast=broadcast)


def patch_join(base: DataFrame, patch: DataFrame, by: Keys, cols: Sequence[str],
               how: str = "left", suffix: str = ".new", broadcast: bool = False) -> DataFrame:
    """Right-biased patch: join ``patch`` onto ``base`` and let every patch
    value win where it is known (``coalesce(new, old)``) for ``cols``.
    Patch columns not in ``cols`` are carried along as in the join."""
    j = join(base, patch, by, how, suffix=("", suffix), broadcast=broadcast)
    repl = {c: F.coalesce(F.col(f"`{c}{suffix}`"), F.col(f"`{c}`")) for c in cols}
    j = j.withColumns(repl)
    return j.drop(*[f"{c}{suffix}" for c in cols])
