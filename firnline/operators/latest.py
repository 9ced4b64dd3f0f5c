"""First, last and latest-rows queries, for all stations in one pass."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..schema import SENSOR_COLS, SENSORS


def time_span(df, key="station_id", ts="ts"):
    return df.groupBy(key).agg(F.min(ts).alias("oldest_ts"), F.max(ts).alias("latest_ts"))


def span_with_fallback(processed, raw, key="station_id", ts="period"):
    """Span of the processed rows; stations without any start at their oldest raw reading."""
    done = time_span(processed, key, ts)
    return time_span(raw, key).select(key, F.col("oldest_ts").alias("_raw")).join(done, key, "left").select(
        key,
        F.coalesce("oldest_ts", "_raw").alias("oldest_ts"),
        F.coalesce("latest_ts", "_raw").alias("latest_ts"),
    )


def latest_id(df, id_col, key="station_id", ts="ts"):
    """Id of the newest row; both buffers are fixed-width, so this stays a hash aggregate."""
    return df.groupBy(key).agg(F.max_by(id_col, ts).alias("latest_id"))


def latest_rows(df, order, n=10, key="station_id"):
    """The ``n`` newest rows of each station; every task cuts to n per station before the shuffle."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def available_sensors(wide, n=10, key="station_id", ts="ts"):
    """Sensors with a value among the newest ``n`` rows of each station."""
    newest = latest_rows(wide, [ts], n, key)
    counts = newest.groupBy(key).agg(*[F.count(c).alias(c) for c in SENSOR_COLS])
    names = F.array_compact(F.array(*[F.when(F.col(c) > 0, F.lit(s)) for s, c in zip(SENSORS, SENSOR_COLS)]))
    return counts.select(key, names.alias("sensors"), (F.col("n") > 0).alias("has_n"))


def station_summary(wide, key="station_id", ts="ts"):
    """Per station its newest time and whether it measured precipitation at all in these rows."""
    return wide.groupBy(key).agg(F.max(ts).alias("latest_ts"), (F.count("n") > 0).alias("has_n"))
