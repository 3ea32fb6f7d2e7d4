"""Typed readers and the NA-writing sink."""

import os
import tempfile

from pyspark.sql import types as T

from plotwise.sources import io


def _write(text):
    d = tempfile.mkdtemp(prefix="plotwise-io-", dir="/tmp")
    p = os.path.join(d, "f.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_read_delim_text_all_text_na_missing(spark):
    p = _write("siteID;turfID;cover\nAlr;Lav1G ;NA\nØvs;;5\n")
    df = io.read_delim_text(spark, p, ["siteID", "turfID", "cover"], sep=";")
    got = [tuple(r) for r in df.collect()]
    assert got == [("Alr", "Lav1G ", None), ("Øvs", None, "5")]


def test_read_delim_typed_decimal_comma_and_blank_text(spark):
    p = _write("old;new;cover\nAch.mil;;1,5\nAgr.cap;NA;x\n")
    schema = T.StructType([T.StructField("old", T.StringType()), T.StructField("new", T.StringType()),
                           T.StructField("cover", T.DoubleType())])
    got = [tuple(r) for r in io.read_delim_typed(spark, p, schema, decimal_comma=True).collect()]
    assert got == [("Ach.mil", "", 1.5), ("Agr.cap", None, None)]


def test_read_sheets_and_write_csv_na(spark):
    d = tempfile.mkdtemp(prefix="plotwise-sheets-", dir="/tmp")
    for i, body in enumerate(["Year,Site\n2016,ALR\n", "Year,Site\n2017,\n"]):
        with open(os.path.join(d, f"sheet{i}.csv"), "w") as f:
            f.write(body)
    schema = T.StructType([T.StructField("Year", T.DoubleType()), T.StructField("Site", T.StringType())])
    df = io.read_sheets(spark, d, schema)
    assert sorted(tuple(r) for r in df.collect()) == [(2016.0, "ALR"), (2017.0, None)]
    out = os.path.join(tempfile.mkdtemp(prefix="plotwise-out-", dir="/tmp"), "o")
    io.write_csv(df.coalesce(1), out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.endswith(".csv"))
    assert "2017.0,NA" in text and text.startswith("Year,Site")


def test_read_csv_inferred(spark):
    p = _write("a,b,c\n1,x,2.5\n2,NA,\n")
    df = io.read_csv(spark, p, infer=True)
    assert dict(df.dtypes) == {"a": "int", "b": "string", "c": "double"}
    assert [tuple(r) for r in df.collect()] == [(1, "x", 2.5), (2, None, None)]


TYPED = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("cover", T.DoubleType())])


def test_bad_cells_and_malformed_rows_are_listed(spark):
    p = _write("id;name;cover\n1;a;2,5\n2;b;WHAT\nx3;NA;NA\n4;c\n5;d;;extra\n6;e; \n7;f;1.5.2\n")
    cells = io.read_cells(spark, p, TYPED.fieldNames())
    bad = [(r.column, r.text) for r in io.bad_cells(cells, TYPED, decimal_comma=True).orderBy(io.POSITION, "column").collect()]
    assert bad == [("cover", "WHAT"), ("id", "x3"), (None, "4;c"), (None, "5;d;;extra"), ("cover", "1.5.2")]
    got = [tuple(r) for r in io.typed_cells(cells, TYPED, decimal_comma=True).collect()]
    assert got[:3] == [(1, "a", 2.5), (2, "b", None), (None, None, None)] and len(got) == 7


def test_position_follows_the_file_over_many_splits(spark):
    d = tempfile.mkdtemp(prefix="plotwise-pos-", dir="/tmp")
    keys = [(i * 7919) % 101 for i in range(6000)]
    for f in range(3):
        with open(os.path.join(d, f"part{f}.csv"), "w") as out:
            out.write("key;line\n" + "".join(f"{k};{f * 2000 + i}\n" for i, k in enumerate(keys[f * 2000 : f * 2000 + 2000])))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        cells = io.read_cells(spark, d, ["key", "line"])
        assert cells.rdd.getNumPartitions() > 20
        assert [int(r.line) for r in cells.orderBy(io.POSITION).collect()] == list(range(6000))
        from plotwise.operators import grouped as G
        first = G.first_row_per_key(cells.select("key", "line", io.POSITION).repartition(9), ["key"], [io.POSITION])
        assert {int(r.key): int(r.line) for r in first.collect()} == {k: keys.index(k) for k in set(keys)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_published_file_round_trip(spark):
    import pytest
    path = os.path.join(tempfile.mkdtemp(prefix="plotwise-pub-", dir="/tmp"), "clean.csv")
    rows = [(1, "a,b \"q\"", 0.1), (2, None, None), (3, "", -1e300), (None, "two\nlines", 1.0), (5, " padded ", 2.0)]
    df = spark.createDataFrame(rows, TYPED)
    io.publish_csv(df, path)
    assert sorted(map(tuple, io.read_published(spark, path, TYPED).collect()), key=repr) == sorted(rows, key=repr)
    assert sorted(f for f in os.listdir(os.path.dirname(path)) if not f.startswith(".")) == ["clean.csv"]
    literal = spark.createDataFrame([*rows, (6, "NA", 3.0)], TYPED)
    old = open(path).read()
    with pytest.raises(ValueError, match="1 cells"):  # it would come back as missing
        io.publish_csv(literal, path)
    assert open(path).read() == old
    io.publish_csv(literal.repartition(4), path, missing="")
    assert sorted(map(tuple, io.read_published(spark, path, TYPED, missing="").collect()), key=repr) == sorted(map(tuple, literal.collect()), key=repr)


def test_failed_write_leaves_the_old_file(spark):
    import pytest
    from pyspark.sql import functions as F
    path = os.path.join(tempfile.mkdtemp(prefix="plotwise-pub-", dir="/tmp"), "clean.csv")
    io.publish_csv(spark.range(3).select(F.col("id").cast("int"), F.lit("x").alias("name"), F.lit(1.0).alias("cover")), path)
    old = open(path).read()
    broken = spark.range(100).select(F.col("id").cast("int"), F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise("x").alias("name"), F.lit(1.0).alias("cover"))
    with pytest.raises(Exception, match="lost"):
        io.publish_csv(broken, path)
    assert open(path).read() == old and [f for f in os.listdir(os.path.dirname(path)) if "_writing" in f] == []
    io.publish_csv(spark.range(0).select(F.col("id").cast("int"), F.lit("x").alias("name")), path)
    assert open(path).read() == "id,name\n"
