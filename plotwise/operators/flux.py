"""Chamber gas-flux processing: match logger readings to measurement
windows, fit the concentration slope, convert to a flux, pair light and dark
measurements.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact as X
from ..functions.semantics import col

# fixed values: gas constant (L atm K^-1 mol^-1) and default chamber setup
# (25 x 25 x 40 cm chamber on a 25 x 25 cm frame, pressure 1 atm; two tubes of
# 3 m length and 4 mm diameter)
GAS_CONSTANT = 0.082057
DEFAULT_PRESSURE_ATM = 1.0
DEFAULT_VOLUME_L = 25.0
DEFAULT_TUBING_L = 2 * 30.0 * math.pi * 0.02 ** 2
DEFAULT_AREA_M2 = 0.0625
# a slope in ppm per second gives micromoles per m2 and second; times this, mmol per m2 and hour
PER_HOUR = 3.6
# a measurement lasts minutes: a longer window is a mistyped time
MAX_WINDOW_SECONDS = 86_400


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def match_windows(readings: DataFrame, windows: DataFrame, ts: str, start: str, end: str,
                  bucket_seconds: int = 60, extra_keys: list[str] | None = None,
                  max_seconds: int = MAX_WINDOW_SECONDS) -> DataFrame:
    """Attach every reading to the measurement window(s) whose
    ``[start, end)`` contains its time (plus equality on ``extra_keys``: the
    logger, so a reading only meets the windows of its own logger).

    Range join without a nested loop: each window is exploded into the
    time buckets it overlaps, readings get their bucket, and the two meet in
    an equi-join on the bucket (and extra keys) followed by the exact bound
    test. The explode factor is at most ``max_seconds`` / ``bucket_seconds``:
    windows that are longer, or end before they start, match nothing and are
    listed by :func:`window_violations`.
    """
    extra_keys = extra_keys or []
    b = bucket_seconds * 1_000_000
    w = windows.filter(_valid_window(start, end, max_seconds)).withColumn(
        "__bucket",
        F.explode(F.sequence(F.floor(_micros(F.col(start)) / b).cast("long"),
                             F.floor((_micros(F.col(end)) - 1) / b).cast("long"))))
    r = readings.withColumn("__bucket", F.floor(_micros(F.col(ts)) / b).cast("long"))
    cond = [r["__bucket"] == w["__bucket"]] + [r[k] == w[k] for k in extra_keys]
    j = r.join(w, cond, "inner").filter((r[ts] >= w[start]) & (r[ts] < w[end]))
    keep = [r[c] for c in readings.columns] + [w[c] for c in windows.columns if c not in extra_keys]
    return j.select(*keep)


def _valid_window(start: str, end: str, max_seconds: int) -> Column:
    length = _micros(F.col(end)) - _micros(F.col(start))
    return F.coalesce((length > 0) & (length <= max_seconds * 1_000_000), F.lit(False))


def window_violations(windows: DataFrame, start: str, end: str, max_seconds: int = MAX_WINDOW_SECONDS) -> DataFrame:
    """The windows that :func:`match_windows` leaves out: a missing time, an
    end not after the start, or a length above ``max_seconds``."""
    return windows.filter(~_valid_window(start, end, max_seconds))


def elapsed_seconds(ts: Column | str, start: Column | str) -> Column:
    """Seconds from ``start`` to ``ts`` (microsecond resolution)."""
    return (_micros(col(ts)) - _micros(col(start))) / F.lit(1_000_000.0)


def flux_from_slope(slope: Column | str, temp_k: Column | str | float = 293.15,
                    pressure: float = DEFAULT_PRESSURE_ATM, volume: float = DEFAULT_VOLUME_L,
                    area: float = DEFAULT_AREA_M2, tubing: float = DEFAULT_TUBING_L) -> Column:
    """flux = slope x P x V / (R x T x A) in mmol per m2 and hour, for a slope
    in ppm per second. V is the chamber and its tubing (litres); ``temp_k`` is
    the air temperature, a column or a number of kelvins."""
    t = temp_k if isinstance(temp_k, Column) else (F.col(temp_k) if isinstance(temp_k, str) else F.lit(temp_k))
    return col(slope) * F.lit(pressure * (volume + tubing) * PER_HOUR) / (F.lit(GAS_CONSTANT) * t * F.lit(area))


def measurement_slopes(matched: DataFrame, keys: list[str], conc: str, seconds: str,
                       out: str = "slope") -> DataFrame:
    """Least-squares slope of concentration over elapsed time per measurement
    (an aggregate: partial sums per task, no per-group collection; the same
    bits whatever the order of the readings)."""
    return matched.groupBy(*keys).agg(X.slope_exact(conc, seconds).alias(out),
                                      F.count(F.lit(1)).alias("n_readings"))


def gep(fluxes: DataFrame, keys: list[str], kind: str, value: str,
        light: str = "NEE", dark: str = "ER") -> DataFrame:
    """Pair each unit's light (NEE) and dark (ER) flux: GEP = NEE - ER.

    Every reading counts: readings of one kind in a unit are averaged, and
    their numbers are returned (``n_<kind>``), so a repeated measurement
    shows. A unit without one of the kinds has no GEP."""
    of = lambda k: F.when(F.col(kind) == F.lit(k), F.col(value))
    p = fluxes.groupBy(*keys).agg(
        X.mean_exact(of(light)).alias(light), X.mean_exact(of(dark)).alias(dark),
        F.count(of(light)).alias(f"n_{light}"), F.count(of(dark)).alias(f"n_{dark}"))
    return p.withColumn("GEP", F.col(light) - F.col(dark))
