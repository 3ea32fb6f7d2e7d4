"""Continuous chamber-flux processing from a logger stream.

The CO2 logger records one reading per second without pause; measurement
windows (plot, start, end) come from the field sheets. Readings are matched
to windows with a stream-static equi-join on a time bucket plus the exact
bounds test, and each measurement is reduced to least-squares sufficient
statistics (n, sums of x, y, xy, xx) - a constant-size state per open
measurement. The watermark on the window end closes a measurement once the
logger has moved past it (plus the allowed lateness), and the slope and flux
are emitted once, in append mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import flux as FX


def measurement_fluxes(readings: DataFrame, windows: DataFrame, ts: str = "ts", conc: str = "conc",
                       start: str = "start", end: str = "end", key: str = "measurement_id",
                       lateness: str = "2 minutes", bucket_seconds: int = 60,
                       temp_k: float = 293.15, logger: str | None = None) -> DataFrame:
    """Streaming (or batch) per-measurement slope and flux.

    ``readings`` may be a streaming DataFrame; ``windows`` is static.
    ``logger`` names the column (in both) that tells loggers apart.
    """
    by = [logger] if logger else []
    m = FX.match_windows(readings.select(ts, conc, *by), windows.select(key, start, end, *by), ts, start, end,
                         bucket_seconds=bucket_seconds, extra_keys=by)
    m = m.withColumn("__x", FX.elapsed_seconds(ts, start)).withWatermark(end, lateness)
    x, y = F.col("__x"), F.col(conc)
    g = m.groupBy(key, start, end).agg(
        F.count(F.lit(1)).alias("n_readings"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * y).alias("sxy"), F.sum(x * x).alias("sxx"))
    n = F.col("n_readings").cast("double")
    den = n * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.when((F.col("n_readings") >= 2) & (den != 0),
                   (n * F.col("sxy") - F.col("sx") * F.col("sy")) / den)
    return g.select(key, start, end, "n_readings", slope.alias("slope"),
                    FX.flux_from_slope(slope, temp_k).alias("flux"))
