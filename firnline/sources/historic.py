"""Historic exports: 12 preamble lines, tab separated, decimal comma, quality status."""

from pyspark.sql import functions as F

from ..functions.text import date_of, decimal_comma
from ..operators.clean import keep_good_status
from ..schema import GOOD_STATUS, PORTAL_START, SENSORS, STATIONS
from .portal import plain_file_name


def parse_historic(lines, cut=PORTAL_START):
    """(value = one text line, file_name) -> station file, sensor, resolution, date, value.

    Preamble and header are whatever does not start with a date; readings from the
    ``cut`` on are in the portal and dropped here; monthly rows move to the month end.
    """
    name = F.col("file_name")
    sensor = F.when(name.contains("HS"), "HS").when(name.contains("LT"), "LT").otherwise("N")
    resolution = F.when(name.contains("Month"), "monthly").when(name.contains("Day"), "daily")
    fields = F.split("value", "\t")
    day = date_of(F.get(fields, F.lit(0)), "dd/MM/yyyy")
    return lines.where(day < F.lit(cut).cast("date")).select(
        name, sensor.alias("sensor"), resolution.alias("resolution"),
        F.when(resolution == "monthly", F.last_day(day)).otherwise(day).alias("date"),
        keep_good_status(decimal_comma(F.get(fields, F.lit(2))), F.get(fields, F.lit(3)), GOOD_STATUS).alias("value"),
    )


def read_historic(spark, path, cut=PORTAL_START):
    lines = spark.read.option("recursiveFileLookup", "true").text(path).withColumn("file_name", plain_file_name())
    return parse_historic(lines, cut)


def station_of_file(file_name):
    """Id of the station whose name without blanks is part of the file name."""
    expr = F.lit(None).cast("int")
    for sid, name, _ in STATIONS:
        expr = F.when(F.col(file_name).contains(name.replace(" ", "")), F.lit(sid)).otherwise(expr)
    return expr


def historic_wide(parsed):
    """One row per station, resolution and date with a column per sensor."""
    return (
        parsed.withColumn("station_id", station_of_file("file_name"))
        .where(F.col("station_id").isNotNull())
        .groupBy("station_id", "resolution", "date")
        .agg(*[F.min(F.when(F.col("sensor") == s, F.col("value"))).alias(s.lower()) for s in SENSORS])
    )
