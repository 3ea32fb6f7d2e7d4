"""Per-key classifications from grouped evidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S


def affinity(df: DataFrame, key: str, zone_col: str, nemoral: Sequence[str], boreal: Sequence[str],
             alpine: Sequence[str], out: str = "affinity") -> DataFrame:
    """Zone affinity of each key from where it occurs: in a ``nemoral`` zone
    and in no ``alpine`` one -> "lowland"; in an ``alpine`` zone and in none
    from nemoral to ``boreal`` (the southern boreal zones) -> "alpine";
    anything else -> "generalist" (a key seen only in ``boreal`` zones too).
    One aggregation with map-side combine: a key seen in many rows costs one
    partial row per task."""
    seen = lambda zones: F.bool_or(S.is_in(zone_col, zones))
    g = df.groupBy(key).agg(seen(nemoral).alias("__nem"), seen(boreal).alias("__bor"), seen(alpine).alias("__alp"))
    nem, bor, alp = F.col("__nem"), F.col("__bor"), F.col("__alp")
    cls = (F.when(nem & ~alp, F.lit("lowland")).when(alp & ~nem & ~bor, F.lit("alpine"))
           .otherwise(F.lit("generalist")))
    return g.select(key, cls.alias(out))


def highest_status(df: DataFrame, keys: Sequence[str], code_col: str, levels: Sequence[str],
                   out: str = "status") -> DataFrame:
    """Highest recorded status per key, by the position of the code in an
    ordered level list (codes outside the list are ignored)."""
    rank = S.level_rank(code_col, levels)
    return (df.withColumn("__rk", rank).filter(F.col("__rk").isNotNull())
            .groupBy(*keys).agg(F.max_by(F.col(code_col), F.col("__rk")).alias(out)))
