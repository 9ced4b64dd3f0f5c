"""Continuous ingest with Structured Streaming.

Watermarks need TIMESTAMP, so streams carry ``event_time`` (the local time read in a
UTC session) and results are cast back to TIMESTAMP_NTZ.
"""

from pyspark.sql import functions as F

from ..plans import update
from ..schema import PORTAL_JSON, rule_name
from ..sources.portal import parse_portal, with_load

# fixed value: weeks run from Monday; the epoch was a Thursday
WEEK_OFFSET = "4 days"
DELAY = "1 hour"


def read_portal_stream(spark, path, files_per_batch=1000):
    """Readings of new portal files, each file taken once (the checkpoint keeps the list)."""
    files = (
        spark.readStream.schema(PORTAL_JSON).option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files_per_batch).json(path)
    )
    return parse_portal(with_load(files))


def with_event_time(readings, delay=DELAY, ts="ts"):
    return readings.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", delay)


def deduplicated(readings, delay=DELAY, keys=("station_id", "sensor")):
    """Drop copies of a reading that arrive again within the delay."""
    return with_event_time(readings, delay).dropDuplicatesWithinWatermark([*keys, "event_time"])


def _until_next_month(event_time):
    """How long from a time to the last instant of its month, as the gap of a session; sessions that touch are one."""
    month = F.add_months(F.trunc(event_time, "MM"), 1).cast("timestamp")
    return F.concat((F.unix_micros(month) - F.unix_micros(event_time) - 1).cast("string"), F.lit(" microseconds"))


def closed_periods(readings, rule, delay=DELAY, keys=("station_id", "sensor"), timed=False):
    """Count, sum and mean of every hour, day, week or month, emitted once it is over.

    Months have no fixed length. They are sessions whose gap lasts until the end of the month: all sessions of a
    month end at the same instant, so they overlap and are one, and those of two months never meet. What is kept of an open
    month is one row per series.
    """
    rule = rule_name(rule)
    windows = {
        "hourly": lambda: F.window("event_time", "1 hour"),
        "daily": lambda: F.window("event_time", "1 day"),
        "weekly": lambda: F.window("event_time", "7 days", startTime=WEEK_OFFSET),
        "monthly": lambda: F.session_window("event_time", _until_next_month("event_time")).alias("window"),
    }
    if rule not in windows:
        raise ValueError(f"no streaming window for rule {rule!r}")
    rows = readings if timed else with_event_time(readings, delay)
    end = F.to_date(F.col("window.end") - F.expr("INTERVAL 1 MICROSECOND")) if rule == "weekly" else F.to_date("window.end")
    label = F.col("window.start") if rule in ("hourly", "daily") else end
    return (
        rows.groupBy(*keys, windows[rule]())
        .agg(F.count("value").alias("readings"), F.sum("value").alias("total"), F.avg("value").alias("mean"))
        .select(*keys, label.cast("timestamp_ntz").alias("period"), "readings", "total", "mean")
    )


def closed_months(daily, keys=("station_id", "sensor")):
    """Months from stored closed days, without the last month of each series (still open)."""
    months = daily.groupBy(*keys, F.last_day("period").alias("month")).agg(
        F.sum("readings").alias("readings"), F.sum("total").alias("total")
    )
    last = daily.groupBy(*keys).agg(F.max("period").alias("_last"))
    return (
        months.join(last, list(keys)).where((F.col("month") < F.last_day("_last")) | (F.col("month") == F.to_date("_last")))
        .select(*keys, F.col("month").cast("timestamp_ntz").alias("period"), "readings", "total",
                F.try_divide("total", "readings").alias("mean"))
    )


def run_to_table(stream, path, checkpoint):
    """Process everything available into a Parquet folder, then stop."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_merge(readings, raw_path, checkpoint, order="load_seq", newest=True, processed_path=None):
    """Overlay every micro-batch on the stored raw rows, as the batch update does; late readings simply replace.

    With ``processed_path`` the periods of the stations of a batch are rebuilt as well. A
    batch that is repeated after a failure overlays the same values again, so the
    table ends up the same.
    """
    def merge(batch, _):
        if processed_path is None:
            update.ingest(batch.sparkSession, batch, raw_path, order, newest)
        else:
            update.ingest_and_rebuild(batch.sparkSession, batch, raw_path, processed_path, order, newest)

    query = readings.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
