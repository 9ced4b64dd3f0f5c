"""Long-term station climate: temperature range and winter precipitation.

Inputs are monthly tables: a station group has twelve rows per year, so the windows
over stations are bounded by the calendar.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .sizes import settled


def yearly(monthly, key="station_id", ts="period"):
    """Per station and year: temperature range, December and January-February precipitation, total."""
    month = F.month(ts)
    rows = monthly.groupBy(key, F.year(ts).alias("year")).agg(
        (F.max("lt") - F.min("lt")).alias("td"),
        F.coalesce(F.sum(F.when(month == 12, F.col("n"))), F.lit(0.0)).alias("december"),
        F.coalesce(F.sum(F.when(month <= 2, F.col("n"))), F.lit(0.0)).alias("january_february"),
        F.coalesce(F.sum("n"), F.lit(0.0)).alias("total"),
    )
    station = Window.partitionBy(key)
    return rows.withColumn("first_year", F.min("year").over(station)).withColumn("last_year", F.max("year").over(station))


def station_climate(monthly, key="station_id", ts="period"):
    """One row per station: td, pptwt and total precipitation.

    td is the mean yearly range without the last year; years without a value do not
    count. pptwt is the mean December-to-February sum of the winters that begin in the
    first to the last-but-one year; empty winters count as 0.
    """
    ended = F.col("year") < F.col("last_year")
    winters = F.sum(F.when(ended, F.col("december")).otherwise(0.0)) + F.sum(
        F.when(F.col("year") > F.col("first_year"), F.col("january_february")).otherwise(0.0)
    )
    return yearly(monthly, key, ts).groupBy(key).agg(
        F.avg(F.when(ended, F.col("td"))).alias("td"),
        F.try_divide(winters, F.max("last_year") - F.max("first_year")).alias("pptwt"),
        F.sum("total").alias("total"),
    )


def temperature_range(monthly, key="station_id", ts="period"):
    return station_climate(monthly, key, ts).where("td IS NOT NULL").select(key, "td")


def winter_precipitation_of(monthly, fallback_id, key="station_id", ts="period"):
    """Mean winter precipitation; stations that measured none take the fallback station's."""
    own = settled(station_climate(monthly, key, ts), "climate")  # one row per station, read twice
    fallback = own.where(F.col(key) == fallback_id).select("pptwt").scalar()
    return own.select(key, F.when(F.col("total") == 0, fallback).otherwise(F.col("pptwt")).alias("pptwt"))


def temperature_range_before(monthly, dates, key="station_id", ts="period", date="date"):
    """Range of the year before each date."""
    years = monthly.groupBy(key, F.year(ts).alias("year")).agg((F.max("lt") - F.min("lt")).alias("td"))
    return dates.withColumn("year", F.year(date) - 1).join(years, [key, "year"], "left").drop("year")


def winter_sums(monthly, key="station_id", ts="period"):
    """December-to-February precipitation by the year the winter began."""
    month = F.month(ts)
    return (
        monthly.where(month.isin(12, 1, 2))
        .groupBy(key, (F.year(ts) - F.when(month <= 2, 1).otherwise(0)).alias("winter"))
        .agg(F.coalesce(F.sum("n"), F.lit(0.0)).alias("pptwt"))
    )


def precipitation_source(monthly, fallback_id, key="station_id"):
    """Station whose precipitation is used: itself, or the fallback when it measured none."""
    total = monthly.groupBy(key).agg(F.coalesce(F.sum("n"), F.lit(0.0)).alias("_t"))
    return total.select(key, F.when(F.col("_t") == 0, F.lit(fallback_id)).otherwise(F.col(key)).alias("source_id"))


def winter_precipitation_before(monthly, dates, fallback_id, key="station_id", ts="period", date="date"):
    """Sum of the winter that ended in each date's year."""
    sums = winter_sums(monthly, key, ts).withColumnRenamed(key, "source_id")
    return (
        dates.withColumn("winter", F.year(date) - 1)
        .join(precipitation_source(monthly, fallback_id, key), key, "left")
        .join(sums, ["source_id", "winter"], "left")
        .withColumn("pptwt", F.coalesce("pptwt", F.lit(0.0)))
        .drop("source_id", "winter")
    )
