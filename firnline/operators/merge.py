"""Overlaying new rows on stored ones, and duplicate handling."""

from pyspark.sql import functions as F


def overlay(old, new, keys, columns, how="full_outer"):
    """Non-null new values win, all else stays; ``how='left'`` keeps only stored keys."""
    keys = list(keys)
    renamed = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    return old.join(renamed, keys, how).select(
        *keys, *[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) for c in columns]
    )


def overlapping(new, stored, keys):
    """New rows whose key is stored already."""
    return new.join(stored.select(*keys), list(keys), "left_semi")


def keep_first(df, keys, order):
    """One row per key, the one with the smallest ``order``.

    Aggregated with map-side combine instead of ranked in a window: a key with any
    number of copies shrinks to one candidate per task before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c != order]
    return df.groupBy(*keys).agg(
        *[F.min_by(c, order).alias(c) for c in rest], F.min(order).alias(order)
    ).select(*df.columns)


def duplicate_excess(df, key="station_id", ts="ts"):
    """Rows beyond the first of each (station, time), per station.

    Copies are counted per time first, so no station's times meet in one task.
    """
    per_time = df.where(F.col(ts).isNotNull()).groupBy(key, ts).agg(F.count("*").alias("_n"))
    return per_time.groupBy(key).agg((F.sum("_n") - F.count("*")).alias("duplicates"))


def duplicate_rows(df, keys):
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
