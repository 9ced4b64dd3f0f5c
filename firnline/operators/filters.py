"""Scans, slices and row filters."""

from pyspark.sql import functions as F

from ..functions.periods import ACCUMULATION_MONTHS
from ..schema import rule_name, sensor_list
from .season import in_season


def _bounded(df, ts, start, end, columns):
    """Closed range of days; on a table with year partitions other years are not read."""
    if "year" in df.columns:
        if start:
            df = df.where(F.col("year") >= int(start[:4]))
        if end:
            df = df.where(F.col("year") <= int(end[:4]))
    if start:
        df = df.where(F.col(ts) >= day_bound(start))
    if end:
        df = df.where(F.col(ts) <= day_bound(end))
    return df.select(*columns)


def day_bound(text):
    """YYYYMMDD -> midnight of that day; None stays open."""
    return None if not text else F.to_date(F.lit(text), "yyyyMMdd").cast("timestamp_ntz")


def scan_raw(wide, station_id, sensors, start=None, end=None):
    """Chosen sensors of one station in a closed time range; prunes columns and partitions."""
    rows = wide.where(F.col("station_id") == station_id)
    return _bounded(rows, "ts", start, end, ["station_id", "ts", *sensor_list(sensors)])


def scan_processed(processed, station_id, rule, sensors, start=None, end=None):
    """One rule of one station in a closed range; the moving average holds snow height only."""
    rule = rule_name(rule)
    cols = ["hs"] if rule == "movavg" else sensor_list(sensors)
    rows = processed.where((F.col("station_id") == station_id) & (F.col("rule") == rule))
    return _bounded(rows, "period", start, end, ["station_id", "period", *cols])


def open_clip(df, ts, left, right):
    return df.where((F.col(ts) > left) & (F.col(ts) < right))


def day_slice(df, ts, first_day, last_day):
    """Closed slice by whole days."""
    return df.where((F.col(ts) >= F.to_date(F.lit(first_day))) & (F.col(ts) < F.date_add(F.to_date(F.lit(last_day)), 1)))


def keep_months(column, date, months):
    """Value inside the months, null outside."""
    return F.when(F.month(date).isin(*months), F.col(column))


def seasons(df, date="date", months=ACCUMULATION_MONTHS, first=None, last=None, skip=()):
    """Seasons between two start years, without the skipped ones."""
    out = in_season(df, date, months)
    if first is not None:
        out = out.where(F.col("season") >= first)
    if last is not None:
        out = out.where(F.col("season") <= last)
    return out.where(~F.col("season").isin(*skip)) if skip else out


def without_snowless(df, key="station_id", column="hs"):
    """Drop (station, season) groups that never show a value other than 0."""
    snowy = df.groupBy(key, "season").agg(F.max(F.abs(column)).alias("_m")).where("_m > 0").select(key, "season")
    return df.join(snowy, [key, "season"], "left_semi")


def is_not_value(column, value):
    return F.col(column).isNull() | (F.col(column) != value)


def not_value(df, column, value):
    """Rows whose column is not the marker value (null stays)."""
    return df.where(is_not_value(column, value))
