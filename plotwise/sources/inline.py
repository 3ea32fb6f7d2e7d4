"""Small fixed tables (dictionaries, rule lists) as JVM-side DataFrames.

``createDataFrame`` on a Python list ships pickled rows through Python
workers on every run; here the rows become literal structs expanded with
``inline`` on a one-row range, so the table is built inside the JVM (and its
size is known to the planner, which broadcasts it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lit(v, dt: T.DataType) -> Column:
    if v is None:
        return F.lit(None).cast(dt)
    if isinstance(dt, T.ArrayType):
        return F.array(*[_lit(x, dt.elementType) for x in v]).cast(dt)
    return F.lit(v).cast(dt)


def inline_table(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    structs = [F.struct(*[_lit(v, f.dataType).alias(f.name) for v, f in zip(r, st.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
