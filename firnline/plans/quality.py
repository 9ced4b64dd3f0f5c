"""Data-quality report per station."""

from pyspark.sql import functions as F

from ..operators.latest import available_sensors


def quality_report(wide):
    """Rows, surplus copies, sensors in use and first and last time of every station.

    Rows are counted per time first, so one station's rows never meet in one task, and
    counts, copies and time span come from the same pass.
    """
    per_time = wide.groupBy("station_id", "ts").agg(F.count("*").alias("_n"))
    counts = per_time.groupBy("station_id").agg(
        F.sum("_n").alias("rows"),
        (F.sum(F.when(F.col("ts").isNotNull(), F.col("_n"))) - F.count("ts")).alias("duplicates"),
        F.min("ts").alias("oldest_ts"),
        F.max("ts").alias("latest_ts"),
    )
    return counts.join(available_sensors(wide), "station_id", "left")
