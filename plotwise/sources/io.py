"""Typed readers and writers for survey sources.

Every reader takes an explicit schema: inference costs an extra pass over
the input and changes with the data. Workbooks are read as sheets exported
to delimited text or parquet (one file per sheet in one directory).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import semantics as S

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A parquet table ``<root>/<name>.parquet`` (filters and column
    selections made later are pushed into the scan)."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


#: Where a row stands in its source: file, first byte of the split it was read in, running number within the split.
POSITION = "source_position"
_CORRUPT = "__malformed"


def source_position() -> Column:
    """Sorts as the rows stand in their files (files by name), however the files were split. To be taken from the scan itself,
    before any shuffle."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def read_cells(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Delimited text as it stands: every cell as text (an empty one is NULL), the row's ``source_position`` and, where a row has
    too many or too few cells, the whole line in ``__malformed``."""
    schema = text_schema(columns).add(_CORRUPT, T.StringType())
    raw = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("mode", "PERMISSIVE")
           .option("columnPruning", False)  # a row is only checked against all its columns
           .option("columnNameOfCorruptRecord", _CORRUPT).schema(schema).csv(path))
    return raw.select("*", source_position().alias(POSITION))


def _number(c: Column, decimal_comma: bool) -> Column:
    return S.to_num_comma(c) if decimal_comma else S.to_num(S.na_text_to_null(c))


def typed_cells(cells: DataFrame, schema: T.StructType, decimal_comma: bool = False, blank_text: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Cells (:func:`read_cells`) with declared types, as :func:`read_delim_typed` gives them, and the columns ``keep``."""
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            out.append((S.base_text_missing(c) if blank_text else S.na_text_to_null(c)).alias(f.name))
        else:
            out.append(_number(c, decimal_comma).cast(f.dataType).alias(f.name))
    return cells.select(*out, *keep)


def bad_cells(cells: DataFrame, schema: T.StructType, decimal_comma: bool = False) -> DataFrame:
    """Cells that hold a text but don't parse as their column's type: (source_position, column, text); a row with too many or too
    few cells is listed with its line and no column. These are NULL in the typed table."""
    numbers = [f.name for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    listed = [F.struct(F.lit(None).cast("string").alias("column"), F.col(_CORRUPT).alias("text"), F.col(_CORRUPT).isNotNull().alias("bad"))]
    for n in numbers:
        c = F.col(f"`{n}`")
        text = S.na_text_to_null(F.trim(c))
        known = text.isNotNull() & (text != "")
        listed.append(F.struct(F.lit(n).alias("column"), c.alias("text"), (known & _number(c, decimal_comma).cast(schema[n].dataType).isNull()).alias("bad")))
    return cells.select(POSITION, F.inline(F.array(*listed))).filter("bad").drop("bad")


def read_delim_text(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";",
                    encoding: str = "UTF-8") -> DataFrame:
    """Delimited text, every column as text, the text ``NA`` missing."""
    df = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .schema(text_schema(columns)).csv(path))
    return df.select([S.na_text_to_null(F.col(f"`{c}`")).alias(c) for c in columns])


def read_delim_typed(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                     decimal_comma: bool = False, blank_text: bool = True) -> DataFrame:
    """Delimited text with declared types. Numbers are parsed leniently
    (bad text -> NULL), optionally with a decimal comma; with ``blank_text``
    a blank text cell stays ``''`` (base reader convention) while ``NA`` is
    missing."""
    raw = (spark.read.option("header", True).option("sep", sep)
           .schema(text_schema(schema.fieldNames())).csv(path))
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            out.append((S.base_text_missing(c) if blank_text else S.na_text_to_null(c)).alias(f.name))
        else:
            num = S.to_num_comma(c) if decimal_comma else S.to_num(S.na_text_to_null(c))
            out.append(num.cast(f.dataType).alias(f.name))
    return raw.select(out)


def read_sheets(spark: SparkSession, directory: str, schema: T.StructType, fmt: str = "csv",
                sheet_col: str | None = None) -> DataFrame:
    """Union of all sheets of a workbook exported one file per sheet into
    ``directory``, read with one declared schema (optionally recording the
    sheet file name)."""
    r = spark.read.schema(schema)
    df = r.option("header", True).csv(directory) if fmt == "csv" else r.parquet(directory)
    if sheet_col:
        df = df.withColumn(sheet_col, F.input_file_name())
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",",
             infer: bool = False) -> DataFrame:
    """Delimited file with header; the text ``NA`` is missing. A schema is
    required; ``infer=True`` instead reads the input twice to find the types
    and is meant for small files of unknown layout."""
    if schema is None and not infer:
        raise ValueError("pass a schema, or infer=True for small files")
    if schema is not None:
        return read_delim_typed(spark, path, schema, sep=sep, blank_text=False)
    df = spark.read.option("header", True).option("sep", sep).option("inferSchema", True).csv(path)
    return df.select([S.na_text_to_null(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`")
                      for c, t in df.dtypes])


def publish_csv(df: DataFrame, path: str, sep: str = ",", missing: str = "NA") -> None:
    """Writes ``df`` as one file with a header, beside ``path`` first, and puts it in place by a rename: a failed write leaves the file
    that was there. ``missing`` stands for missing values; a text cell of just that text would be read back as missing, so it
    fails the write (its cells are counted on the way). With ``missing=""`` every text comes back, as an empty text is
    written in quotes. One task writes the file; larger tables are written as folders (:func:`write_csv`)."""
    spark = df.sparkSession
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)] if missing else []
    clash = reduce(lambda a, b: a + b, [F.coalesce((F.col(f"`{c}`") == missing).cast("long"), F.lit(0)) for c in texts], F.lit(0))
    seen, aside = Observation(), f"{path}._writing-{uuid.uuid4().hex}"
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(conf)
    try:
        (df.observe(seen, F.sum(clash).alias("n")).coalesce(1).write.option("header", True).option("sep", sep).option("nullValue", missing)
         .option("emptyValue", '""').option("quote", '"').option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(aside))
        if seen.get["n"]:
            raise ValueError(f"{seen.get['n']} cells hold the text {missing!r} itself: choose another text for missing values")
        parts = [s.getPath() for s in files.listStatus(at(aside)) if s.getPath().getName().startswith("part-")]
        if not parts:  # a table without partitions
            out = files.create(at(f"{aside}/part-empty"))
            out.write(bytearray((sep.join(df.columns) + "\n").encode()))
            out.close()
            parts = [at(f"{aside}/part-empty")]
        over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf).rename(parts[0], files.makeQualified(at(path)), over)
    finally:
        files.delete(at(aside), True)


def read_published(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", missing: str = "NA") -> DataFrame:
    """A published file with declared types, as it was before."""
    empty = "\x01"  # what an empty text in quotes is read as, to tell it from a missing one
    df = (spark.read.option("header", True).option("sep", sep).option("nullValue", missing).option("emptyValue", empty).option("quote", '"').option("escape", '"')
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .option("multiLine", True).option("mode", "FAILFAST").schema(schema).csv(path))
    return df.select([F.when(F.col(f"`{f.name}`") == empty, F.lit("")).otherwise(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
                      for f in schema.fields])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header + ``NA`` for missing values, one directory of part files."""
    df.write.mode(mode).option("header", True).option("nullValue", "NA").csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
