"""Reading the driver tables and staging intermediate results in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset
    and the master is local (tests), a temporary folder; on a cluster, an error."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = "file://" + tempfile.mkdtemp(prefix="plotwise-")
    spark.conf.set("spark.plotwise.shared.dir", made)
    return made


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.plotwise.shared.dir", None)
    return f"{(known or shared_dir(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back: lineage ends there, and a
    lost executor costs a re-read."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(*staged: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more."""
    for df in staged:
        context = df.sparkSession.sparkContext
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


#: Most words of a sieve (16 bytes each, so a broadcast of 4 MB at most).
SIEVE_WORDS = 1 << 18


def sift(df: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits ``df`` into rows whose ``column`` may be among ``ids`` (one column, staged) and rows whose
    isn't, by a bitmap of hashes. The bitmap has a fixed largest size, so it may be broadcast; when there are more
    ids than it can tell apart, more rows count as possible. Only these need the exact join, so only they
    are shuffled."""
    name = ids.columns[0]
    n = min(SIEVE_WORDS, max(64, ids.count()))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(n))
    bit = lambda c: F.shiftrightunsigned(F.xxhash64(c, F.lit(1)), 58).cast("int")
    mask = F.expr("shiftleft(1L, _bit)")
    word, bits, own = fresh(df, "_word", "_bits", "_bit")
    sieve = (ids.select(slot(F.col(name).cast("long")).alias(word), bit(F.col(name).cast("long")).alias("_bit"))
             .groupBy(word).agg(F.bit_or(mask).alias(bits)))
    id_ = F.col(column).cast("long")
    hit = F.coalesce(F.expr(f"getbit(`{bits}`, `{own}`)") == 1, F.lit(False)) & id_.isNotNull()
    tried = df.withColumn(own, bit(id_)).join(F.broadcast(sieve), slot(id_) == F.col(word), "left")
    return tried.filter(hit).select(*[df[c] for c in df.columns]), tried.filter(~hit).select(*[df[c] for c in df.columns])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names for internal use that don't clash with those of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


_resident: dict = {}


def resident(key, make):
    """What a Python worker keeps between tasks: one object at a time. The next operator's takes the place of the last
    one's, so the memories of a pipeline's stages don't add up in workers that serve them all."""
    if key not in _resident:
        _resident.clear()
        _resident[key] = make()
    return _resident[key]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once per application, so that
    functions run where the package isn't installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="plotwise-")) / "plotwise_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, str(p.relative_to(package.parent)))
    context.addPyFile(str(target))
