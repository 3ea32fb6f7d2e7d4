"""A key holding a third of all rows: grouped statistics are pre-aggregated
and the join back is split by AQE instead of landing in one task."""

from pyspark.sql import functions as F

from plotwise.operators import grouped as G
from plotwise.operators import impute as I

from helpers import rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",  # force the sort-merge path
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _skewed(spark, n=30000):
    # key 0 holds a third of the rows, the rest spread over 2000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        (F.col("id") % 97).cast("double").alias("v"), F.col("id"))


def test_group_mutate_hot_key_is_split(spark):
    def run():
        df = _skewed(spark)
        out = G.group_mean(df, ["k"], "v", "m")
        res = out.collect()  # executes this plan, so AQE's final plan is visible
        plan = out._jdf.queryExecution().executedPlan().toString()
        return sorted({r.m for r in res if r.k == 0}), plan
    got, plan = _with_conf(spark, SKEW_CONF, run)
    expect = sum(float(i % 97) for i in range(0, 30000, 3)) / 10000
    assert got == [expect]
    assert "skew=true" in plan


def test_gated_rescale_hot_group(spark):
    df = _skewed(spark).select("k", F.lit(1).alias("yr"),
                               F.when(F.col("id") % 2 == 0, F.lit("Siri")).otherwise(F.lit("Owen")).alias("rec"),
                               "v", F.lit(1e9).alias("tv"))
    out = _with_conf(spark, SKEW_CONF, lambda: I.ratio_gated_rescale(
        df, ["k", "yr"], "v", "rec", "tv", [I.GateRule("Siri", "<", 1.35, 2.0)]).agg(F.sum("v")).first()[0])
    # reference: every group with a Siri row (its sum is far below 1.35 x total) is doubled
    from pyspark.sql import Window
    has_siri = F.max((F.col("rec") == "Siri").cast("int")).over(Window.partitionBy("k"))
    ref = df.select(F.when(has_siri == 1, F.col("v") * 2.0).otherwise(F.col("v")).alias("v")).agg(F.sum("v")).first()[0]
    assert out == ref
