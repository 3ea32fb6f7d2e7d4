"""Streaming flux: logger readings arrive as files; measurements close on
the watermark and are emitted once."""

import datetime as dt
import tempfile

from plotwise.streaming.flux_stream import measurement_fluxes


def test_measurement_fluxes_stream(spark):
    base = dt.datetime(2021, 7, 1, 12, 0, 0)
    src = tempfile.mkdtemp(prefix="plotwise-stream-", dir="/tmp")
    schema = "ts timestamp, conc double"
    windows = spark.createDataFrame(
        [("m1", base, base + dt.timedelta(seconds=120)),
         ("m2", base + dt.timedelta(seconds=180), base + dt.timedelta(seconds=300)),
         ("m3", base + dt.timedelta(hours=2), base + dt.timedelta(hours=2, seconds=60))],
        "measurement_id string, start timestamp, end timestamp")

    def put(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{src}/{name}")

    stream = spark.readStream.schema(schema).parquet(f"{src}/*")
    q = (measurement_fluxes(stream, windows).writeStream.outputMode("append").format("memory")
         .queryName("fluxes_out").start())
    try:
        put([(base + dt.timedelta(seconds=s), 400.0 + 0.5 * s) for s in range(0, 300)], "b1")
        q.processAllAvailable()
        put([(base + dt.timedelta(hours=2, seconds=s), 500.0 - s) for s in range(0, 60)], "b2")
        q.processAllAvailable()
        got = {r.measurement_id: (r.n_readings, round(r.slope, 9)) for r in spark.table("fluxes_out").collect()}
    finally:
        q.stop()
    assert got["m1"] == (120, 0.5) and got["m2"] == (120, 0.5)
    assert "m3" not in got  # still open: the watermark has not passed its end


def test_measurement_fluxes_batch_equals_operator(spark):
    base = dt.datetime(2021, 7, 1, 12, 0, 0)
    readings = spark.createDataFrame([(base + dt.timedelta(seconds=s), 400.0 + 0.25 * s + (s % 3)) for s in range(200)],
                                     "ts timestamp, conc double")
    windows = spark.createDataFrame([("m1", base, base + dt.timedelta(seconds=150))],
                                    "measurement_id string, start timestamp, end timestamp")
    r = measurement_fluxes(readings, windows).first()
    from plotwise.operators import flux as FX
    m = FX.match_windows(readings, windows, "ts", "start", "end").withColumn("x", FX.elapsed_seconds("ts", "start"))
    s = FX.measurement_slopes(m, ["measurement_id"], "conc", "x").first()
    assert abs(r.slope - s.slope) < 1e-9 and r.n_readings == s.n_readings == 150
