"""Removal of implausible readings.

Steps run one after another and each sees the nulls the step before left behind;
comparisons with null keep the value. The jump steps take the window of the
previous row, so a caller can run them per series or per chunk (see chunks.py).
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .chunks import CHUNK_ROWS, with_halo

# rows the chained steps look back
SNOW_REACH = 3
TEMPERATURE_REACH = 2
CONDUCTIVITY_REACH = 2


def instant(df, ts="ts"):
    """The column that orders a series."""
    return "ts_utc" if "ts_utc" in df.columns else ts


def null_where(df, column, condition):
    return df.withColumn(column, F.when(condition, F.lit(None)).otherwise(F.col(column)))


def series_window(key="station_id", ts="ts"):
    """Whole-series window, for tables bounded by the calendar such as daily ones."""
    return Window.partitionBy(key).orderBy(ts)


def jump(column, window):
    return F.col(column) - F.lag(column).over(window)


def clean_snow(df, window, ts="ts"):
    """Range check, no deep snow in July to September, no jumps, no growth above 5 degrees."""
    hs = F.col("hs")
    df = df.withColumn(
        "hs",
        F.when((hs < 0) | (hs > 250), F.lit(None))
        .when(F.month(ts).isin(7, 8, 9) & (hs > 5), F.lit(0.0))
        .otherwise(hs),
    )
    df = null_where(df, "hs", jump("hs", window) > 10)
    df = null_where(df, "hs", jump("hs", window) < -10)
    return null_where(df, "hs", (F.col("hs") > F.lag("hs").over(window)) & (F.col("lt") > 5))


def clean_temperature(df, window):
    lt = F.col("lt")
    df = null_where(df, "lt", (lt <= -30) | (lt >= 35))
    df = null_where(df, "lt", jump("lt", window) > 5)
    return null_where(df, "lt", jump("lt", window) < -5)


def clean_precipitation(df):
    return df.withColumn("n", F.when(F.col("n") >= 0, F.col("n")))


def clean_humidity(df):
    return df.withColumn("lf", F.when(F.col("lf") >= 0, F.col("lf")))


def clean_radiation(df):
    """Mean W/m2 of ten minutes to MJ/m2."""
    df = df.withColumn("gs", F.col("gs") * 0.0006)
    return df.withColumn("gs", F.when(F.col("gs") >= 0, F.col("gs")))


def clean_sunshine(df):
    """Seconds to hours."""
    df = df.withColumn("sd", F.col("sd") / 3600)
    return df.withColumn("sd", F.when(F.col("sd") >= 0, F.col("sd")))


def clean_raw(df, window, ts="ts"):
    """All sensors of a wide frame; snow comes first because it needs the uncleaned temperature."""
    df = clean_temperature(clean_snow(df, window, ts), window)
    return clean_sunshine(clean_radiation(clean_humidity(clean_precipitation(df))))


def clean_series(df, chunk_rows=CHUNK_ROWS):
    """clean_raw over any number of stations and any length of series, one data shuffle.

    Readings follow each other by UTC time where the frame has it; months are those of the local time.
    """
    return with_halo(df, clean_raw, order=instant(df), before=SNOW_REACH, chunk_rows=chunk_rows)


def clean_conductivity(df, window):
    """Spring logger: drop both values where the conductance jumps or is not above 50."""
    step = jump("slt", window)
    df = df.withColumn("wt", F.when((step > 5) | (step < -5) | (F.col("slt") <= 50), F.lit(None)).otherwise(F.col("wt")))
    df = null_where(df, "slt", jump("slt", window) > 5)
    df = null_where(df, "slt", jump("slt", window) < -5)
    return null_where(df, "slt", F.col("slt") <= 50)


def keep_good_status(value, status, good):
    """The value where its quality status is the good one, else null."""
    status = F.col(status) if isinstance(status, str) else status
    return F.when(status == good, F.col(value) if isinstance(value, str) else value)


def zero_periods(df, overrides, column, key="station_id", date="date"):
    """Set ``column`` to 0 inside the (key, from_date, to_date) rows of ``overrides``.

    The ranges are spread to days first, so this is an equi-join on (key, day).
    """
    days = (
        overrides.select(key, F.explode(F.sequence("from_date", "to_date")).alias(date))
        .distinct()
        .withColumn("_zero", F.lit(True))
    )
    return (
        df.join(days, [key, date], "left")
        .withColumn(column, F.when(F.col("_zero"), F.lit(0.0)).otherwise(F.col(column)))
        .drop("_zero")
    )
