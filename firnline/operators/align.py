"""Long sensor readings to one wide row per station and time."""

from pyspark.sql import functions as F

from ..schema import SENSOR_COLS, SENSORS
from .sizes import settled


def _cells(order, newest=False):
    """One aggregate per sensor; the earliest copy by ``order`` wins, or the newest."""
    pick_by = F.max_by if newest else F.min_by

    def pick(sensor):
        hit = F.col("sensor") == sensor
        if order is None:
            return F.min(F.when(hit, F.col("value")))
        return pick_by(F.when(hit, F.col("value")), F.when(hit & F.col("value").isNotNull(), F.col(order)))

    return [pick(s).alias(c) for s, c in zip(SENSORS, SENSOR_COLS)]


def pivot_sensors(readings, order=None, key="station_id", ts="ts"):
    """One row per (station, time), one column per sensor.

    Conditional aggregates keep this a single, map-side combined hash aggregation, so
    any number of copies of one reading shrinks before the shuffle.
    """
    return readings.groupBy(key, ts).agg(*_cells(order))


def pivot_measured(readings, order=None, key="station_id", ts="ts"):
    """pivot_sensors without the times at which nothing was measured.

    Emptiness is decided by a count of its own, so a reader of one sensor does not make
    Spark carry the other columns through the shuffle.
    """
    measured = F.count(F.when(F.col("sensor").isin(*SENSORS), F.col("value")))
    rows = readings.groupBy(key, ts).agg(*_cells(order), measured.alias("_measured"))
    return rows.where("_measured > 0").drop("_measured")


def pivot_delivery(readings, order=None, newest=True, key="station_id"):
    """One row per (station, UTC time) with its local time, each cell with its sequence number (see sources.store).

    The UTC time is the key, so the two readings that share a local hour in autumn stay two rows. The number is
    ``order``, of which the highest wins, or the lowest if not ``newest``; of equal numbers the higher value. Without
    ``order`` the cells have no numbers.
    """
    hit = F.col("sensor").isin(*SENSORS) & F.col("value").isNotNull()
    if order is None:
        number = F.lit(0).cast("long")
    else:
        in_time = dict(readings.dtypes)[order].startswith("timestamp")
        number = F.unix_micros(F.col(order).cast("timestamp")) if in_time else F.col(order).cast("long")
        number = number * (1 if newest else -1)
    # copies under one number are settled first, so that the choice below has no ties
    single = readings.where(hit).groupBy(key, "ts_utc", "sensor", number.alias("_seq")).agg(F.max("value").alias("value"), F.min("ts").alias("ts"))
    cells = []
    for sensor, c in zip(SENSORS, SENSOR_COLS):
        own = F.when(F.col("sensor") == sensor, F.col("_seq"))
        cells += [F.max_by("value", own).alias(c), *([F.max(own).alias(f"{c}_seq")] if order is not None else [])]
    return single.groupBy(key, "ts_utc").agg(F.min("ts").alias("ts"), *cells)


def drop_empty(wide):
    return wide.dropna("all", subset=list(SENSOR_COLS))


def anchor_span(readings, anchors=("LT", "SD"), key="station_id", ts="ts"):
    """First and last time of the first anchor sensor each station has."""
    spans = readings.where(F.col("sensor").isin(*anchors)).groupBy(key).agg(
        *[F.min(F.when(F.col("sensor") == a, F.col(ts))).alias(f"lo_{a}") for a in anchors],
        *[F.max(F.when(F.col("sensor") == a, F.col(ts))).alias(f"hi_{a}") for a in anchors],
    )
    return spans.select(
        key,
        F.coalesce(*[F.col(f"lo_{a}") for a in anchors]).alias("grid_from"),
        F.coalesce(*[F.col(f"hi_{a}") for a in anchors]).alias("grid_to"),
    )


def align(readings, order=None, anchors=("LT", "SD"), step_seconds=300, key="station_id", ts="ts"):
    """Wide rows on the time grid that starts at the station's first anchor reading.

    Replaces a six-way join against an explicit grid: grid points without any reading
    would be dropped again, so it is enough to keep the readings that lie on the grid.
    """
    wide = pivot_measured(readings, order, key, ts)
    on_grid = F.timestamp_diff("SECOND", F.col("grid_from"), F.col(ts)) % step_seconds == 0
    return (
        wide.join(settled(anchor_span(readings, anchors, key, ts), "span"), key)
        .where(F.col(ts).between(F.col("grid_from"), F.col("grid_to")) & on_grid)
        .drop("grid_from", "grid_to")
    )


def grid(spans, step_seconds=300, key="station_id", ts="ts"):
    """All grid times of each station, for callers that want gaps as rows.

    Days are spread over tasks first, then each day to its steps, so that one long
    span is not unrolled in one task.
    """
    lo, hi = F.col("grid_from"), F.col("grid_to")
    day_s = 86400 - 86400 % step_seconds
    blocks = F.sequence(F.lit(0), F.floor(F.timestamp_diff("SECOND", lo, hi) / day_s).cast("int"))
    steps = F.sequence(F.lit(0), F.lit(day_s // step_seconds - 1))
    at = lo + F.make_dt_interval(secs=(F.col("_b") * day_s + F.col("_s") * step_seconds).cast("decimal(18,6)"))
    return (
        spans.select(key, "grid_from", "grid_to", F.explode(blocks).alias("_b"))
        .repartition(key, "_b")
        .select(key, "grid_from", "grid_to", "_b", F.explode(steps).alias("_s"))
        .select(key, at.alias(ts), "grid_to")
        .where(F.col(ts) <= hi)
        .drop("grid_to")
    )


def densify(wide, spans, step_seconds=300, key="station_id", ts="ts"):
    """Every grid time of every station, with nulls where nothing was measured."""
    return grid(spans, step_seconds, key, ts).join(wide, [key, ts], "left")
