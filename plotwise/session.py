"""Session construction and lineage helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings every plotwise job expects. AQE re-plans joins from runtime sizes
# (broadcasts only what it measured to be small) and splits skewed join
# partitions; the session time zone is pinned so timestamps never shift.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # fall back from whole-stage code generation when a fused stage's method
    # exceeds what the JVM will JIT-compile (8000 bytes of bytecode): long
    # chains of rule projections would otherwise run interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # checkpoint files of frames that went out of scope are removed from the
    # shared checkpoint folder instead of accumulating run after run
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "plotwise", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with plotwise defaults.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the data (about
    128-256 MB of shuffle output per partition).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - no SparkContext under Spark Connect
        pass
    return spark


def staging_dir(spark: SparkSession) -> str | None:
    """A folder for :func:`stage`: the shared checkpoint folder where one is
    named; with a local master (tests, single machine) else a temporary
    folder; None on a cluster that names none."""
    d = checkpoint_dir(spark)
    if d:
        return d.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        return None
    return "file://" + tempfile.mkdtemp(prefix="plotwise-staging-")


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (Spark Connect)
        return spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
    return d


def stage_observed(df: DataFrame, folder: str | None, name: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, dict]:
    """:func:`stage`, and aggregates over all rows that are taken while they
    are written (``Observation``), so they cost no pass of their own.
    ``folder=None``: nothing is written, the aggregates are one pass.
    """
    short = {f"m{i}": c for i, c in enumerate(metrics.values())}
    aggs = [c.alias(k) for k, c in short.items()]
    if folder is None:
        out, got = df, df.agg(*aggs).first().asDict()
    else:
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        out = stage(df.observe(seen, *aggs), folder, name)
        got = seen.get
    return out, {m: got[k] for m, k in zip(metrics, short, strict=True)}


def stage(df: DataFrame, folder: str | None, name: str) -> DataFrame:
    """Cut the lineage of a frame that is read several times: write it as
    Parquet under ``folder`` (shared by all executors) and read it back, so
    later readers prune columns, see statistics and survive a lost executor.
    ``folder=None`` leaves the plan as it is (every reader recomputes it).
    """
    if folder is None:
        return df
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
