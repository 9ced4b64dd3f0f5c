"""Evaporation, water balance, baseflow and inflow of the lakes (daily tables)."""

from pyspark.sql import functions as F

from ..functions.hydro import (
    catchment_area,
    daylight_hours,
    effective_precipitation,
    extraterrestrial_radiation,
    groundwater_outflow,
    inflow,
    lake_area,
    lake_mm,
    penman_evaporation,
    seepage,
)
from ..functions.periods import EVAPORATION_MONTHS
from ..operators.filters import keep_months
from ..operators.season import melt
from ..schema import EVAPOTRANSPIRATION_SHARE, LAKES, STATION_ID


def station_days(daily, station_id, *columns):
    return daily.where(F.col("station_id") == station_id).select("date", *columns)


def within_span(df, other, date="date", other_date="date"):
    """Rows inside the date range of another table, as two scalar subqueries."""
    bounds = other.agg(F.min(other_date).alias("lo"), F.max(other_date).alias("hi"))
    return df.where(F.col(date).between(bounds.select("lo").scalar(), bounds.select("hi").scalar()))


def penman_daily(daily, radiation_station=STATION_ID["St. Martin"], air_station=STATION_ID["Rossalm"]):
    """Radiation of one station, temperature and humidity of another, joined by date."""
    rows = (
        station_days(daily, radiation_station, "gs")
        .join(station_days(daily, air_station, "lt", "lf"), "date")
        .dropna("any")
    )
    return (
        rows.withColumn("daylight_hours", daylight_hours(F.month("date")))
        .withColumn("ra", extraterrestrial_radiation(F.month("date")))
        .withColumn("epen", penman_evaporation("gs", "lt", "lf", "ra"))
    )


def lake_evaporation(lake_calc, penman, strict=False):
    """Evaporated volume per lake day, and as water column over the catchment.

    The catchment value is taken before the volume is limited to June to October. A day
    without evaporation gives null, or an error when ``strict``.
    """
    sentinel = F.lit(False)
    for name, spec in LAKES.items():
        if spec["sentinel_wd"] is not None:
            sentinel = sentinel | ((F.col("lake") == name) & (F.col("wd") == spec["sentinel_wd"]))
    lake = lake_calc.where(F.col("wd").isNotNull() & ~sentinel).withColumn(
        "area_glatt", F.coalesce("area_glatt", lake_area("lake", "wd"))
    )
    rows = lake.join(penman.select("date", "epen", F.lit(True).alias("_hit")), "date", "left")
    if strict:
        rows = rows.withColumn(
            "epen", F.when(F.col("_hit"), F.col("epen")).otherwise(F.raise_error(F.concat(F.lit("no evaporation on "), F.col("date").cast("string"))).cast("double"))
        )
    rows = rows.drop("_hit").withColumn("epen_area", F.col("area_glatt") * F.col("epen"))
    rows = rows.withColumn("epen_shed", -(F.col("epen_area") / catchment_area("lake")))
    return rows.withColumn("epen_area", keep_months("epen_area", "date", EVAPORATION_MONTHS))


def water_balance(lake_log, daily, swe, precipitation_station=STATION_ID["Wolkenstein"],
                  snow_station=STATION_ID["Rossalm"], share=EVAPOTRANSPIRATION_SHARE):
    """Groundwater term that closes the balance of each lake day: lake, date, ssgw, n, snowmelt, lakestorage.

    ``swe`` is cut to the lake dates before the melt is formed, so its last day is null.
    """
    rain = station_days(daily, precipitation_station, effective_precipitation("n", share).alias("n"))
    snow = within_span(swe.where(F.col("station_id") == snow_station), lake_log)
    snow = melt(snow, "swe", "snowmelt").select("date", "snowmelt")
    rows = (
        lake_log.select("lake", "date", lake_mm("w_change", "lake").alias("lakestorage"))
        .join(rain, "date", "left")
        .join(snow, "date", "left")
    )
    ssgw = F.col("n") + F.col("snowmelt") - groundwater_outflow("lake") - F.col("lakestorage")
    return rows.select("lake", "date", ssgw.alias("ssgw"), "n", "snowmelt", "lakestorage")


def baseflow(lake_log, daily, lake, first, last, share=EVAPOTRANSPIRATION_SHARE,
             precipitation_station=STATION_ID["Wolkenstein"]):
    """Lake change in mm beside precipitation and effective precipitation, over one slice of days."""
    days = lake_log.where(
        (F.col("lake") == lake) & F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    ).select("date", lake_mm("w_change", "lake").alias("w_change_shed"))
    rain = within_span(station_days(daily, precipitation_station, "n"), days)
    return days.join(
        rain.select("date", "n", effective_precipitation("n", share).alias("n_effective")), "date", "full_outer"
    )


def inflow_outflow(lake_log, daily, swe, lake="Limo", precipitation_station=STATION_ID["Wolkenstein"],
                   snow_station=STATION_ID["Rossalm"]):
    """Precipitation, snowmelt (null when the snow does not shrink) and lake change of each day."""
    days = lake_log.where(F.col("lake") == lake).select("date", lake_mm("w_change", "lake").alias("w_change_shed"))
    rain = within_span(station_days(daily, precipitation_station, "n"), days)
    snow = within_span(swe.where(F.col("station_id") == snow_station), days)
    snow = melt(snow, "swe", "snowmelt", otherwise=None).select("date", "snowmelt")
    return days.join(rain, "date", "full_outer").join(snow, "date", "full_outer")


def recession(events):
    """Seepage of each (high, low) stand and the inflow it implies for a given seepage."""
    cols = ("high_date", "high_volume", "low_date", "low_volume")
    return events.withColumn("seepage", seepage(*cols)).withColumn("inflow", inflow(*cols, "seepage_ls"))
