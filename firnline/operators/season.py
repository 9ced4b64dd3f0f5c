"""Seasonal accumulation and day-to-day differences.

The windows here run over daily tables: a (station, season) group has at most a
year of rows, a (station) or (lake) group one row per calendar day.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.periods import ACCUMULATION_MONTHS, in_months, season_start_year


def in_season(df, date="date", months=ACCUMULATION_MONTHS):
    """Rows of the season's months with the year the season began in."""
    return df.where(in_months(date, months)).withColumn("season", season_start_year(date, months[0]))


def accumulate(df, column, key="station_id", date="date"):
    """Rise since the row before (0 at the season start and next to gaps) and its running sum."""
    w = Window.partitionBy(key, "season").orderBy(date)
    rise = F.greatest(F.coalesce(F.col(column) - F.lag(column).over(w), F.lit(0.0)), F.lit(0.0))
    return df.withColumn("rise", rise).withColumn(
        "cum", F.sum("rise").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )


def season_maximum(accumulated, key="station_id"):
    return accumulated.groupBy(key, "season").agg(F.max("cum").alias("max_cum"))


def melt(df, column, out, key="station_id", date="date", otherwise=0.0):
    """Decrease to the next row; ``otherwise`` where it does not fall, null on the last row."""
    w = Window.partitionBy(key).orderBy(date)
    nxt = F.lead(column).over(w)
    last = F.lead(F.lit(1)).over(w).isNull()
    return df.withColumn(
        out,
        F.when(last, F.lit(None).cast("double")).when(F.col(column) > nxt, F.col(column) - nxt).otherwise(F.lit(otherwise).cast("double")),
    )


def storage_change(df, column="volume", out="w_change", key="lake", date="date"):
    w = Window.partitionBy(key).orderBy(date)
    return df.withColumn(out, F.lead(column).over(w) - F.col(column))


def yearly_maxima(df, measured="volume", calculated="vol_calc", key="lake", date="date"):
    """Largest measured volume of each year, the calculated one where nothing was measured."""
    return (
        df.groupBy(key, F.year(date).alias("year"))
        .agg(F.max(measured).alias("max_log"), F.max(calculated).alias("max_calc"))
        .withColumn("max_vol", F.coalesce("max_log", "max_calc"))
    )


def pair_with_winter(yearly, seasons, key_year="year"):
    """Each year's value next to the season that began the year before."""
    return yearly.join(seasons, F.col(key_year) == F.col("season") + 1)
