"""Which portal requests are needed to bring every station up to date."""

from pyspark.sql import functions as F

from ..schema import PORTAL_START, REQUEST_DAYS, REQUEST_DAYS_PRECIPITATION


def plan_requests(latest, today, sensors="sensors", key="station_id"):
    """(station, latest_date, array of sensors) -> one row per station, sensor and request.

    The span runs from the latest stored day to ``today`` (a date column or literal)
    and is cut into equal parts no longer than the portal serves at once. Stations
    that are up to date get no request; nothing starts before the portal's first day.
    """
    rows = latest.withColumn("to_date", today).where(F.col("latest_date") != F.col("to_date"))
    rows = rows.select(
        key, F.explode(sensors).alias("sensor"),
        F.greatest(F.col("latest_date"), F.lit(PORTAL_START).cast("date")).alias("start"), "to_date",
    )
    days = F.datediff("to_date", "start")
    limit = F.when(F.col("sensor") == "N", REQUEST_DAYS_PRECIPITATION).otherwise(REQUEST_DAYS)
    rows = rows.select("*", days.alias("days"), limit.alias("limit")).withColumn(
        "parts", F.when(F.col("days") >= F.col("limit"), F.ceil(F.col("days") / F.col("limit"))).otherwise(1).cast("int")
    )
    part_days = F.col("days") / F.col("parts")

    def cut(i):
        return F.date_add("start", F.ceil(i * part_days).cast("int"))

    return rows.withColumn("part", F.explode(F.sequence(F.lit(1), F.col("parts")))).select(
        key, "sensor", "part", cut(F.col("part") - 1).alias("date_from"), cut(F.col("part")).alias("date_to")
    )
