"""Snow-water equivalent of days and periods."""

from pyspark.sql import functions as F

from ..functions.hydro import hydro_day, snow_water_equivalent
from ..operators.climate import station_climate, temperature_range_before, winter_precipitation_before
from ..operators.sizes import settled
from ..schema import STATION_ID


def _swe(df):
    return df.withColumn("swe", snow_water_equivalent("hs", "pptwt", "td", hydro_day("date")))


def climate(monthly, precipitation_station=None, fallback_id=STATION_ID["Wolkenstein"]):
    """Temperature range and winter precipitation of every station (one row each).

    With ``precipitation_station`` all stations take that station's precipitation;
    otherwise each has its own, or the fallback's where it measured none.
    """
    own = settled(station_climate(monthly), "climate")  # one row per station, read twice
    other = fallback_id if precipitation_station is None else precipitation_station
    borrowed = own.where(F.col("station_id") == other).select("pptwt").scalar()
    if precipitation_station is None:
        borrowed = F.when(F.col("total") == 0, borrowed).otherwise(F.col("pptwt"))
    return own.select("station_id", "td", borrowed.alias("pptwt"))


def swe_period(daily, monthly, start=None, end=None, precipitation_station=None):
    """SWE of every station and day from the long-term climate: date, hs, lt, swe."""
    rows = daily.select("station_id", "date", "hs", "lt")
    if start is not None:
        rows = rows.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(F.col("date") <= F.lit(end).cast("date"))
    out = _swe(rows.join(climate(monthly, precipitation_station), "station_id"))
    return out.select("station_id", "date", "hs", "lt", "swe")


def swe_at(daily, monthly, date, precipitation_station=None):
    """SWE of one day."""
    return swe_period(daily, monthly, date, date, precipitation_station)


def swe_specific(daily, monthly, start=None, end=None, fallback_id=STATION_ID["Wolkenstein"]):
    """SWE from each day's own preceding year and winter."""
    rows = daily.select("station_id", "date", "hs")
    if start is not None:
        rows = rows.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(F.col("date") <= F.lit(end).cast("date"))
    rows = temperature_range_before(monthly, rows)
    rows = winter_precipitation_before(monthly, rows, fallback_id)
    return _swe(rows).select("station_id", "date", "hs", "td", "pptwt", "swe")
