"""Row windows over long series, cut into chunks of rows so no station is one task.

A window partitioned by station alone sorts a whole station in one task. Every
row window here reaches only a fixed number of rows back or forward, so the
series is cut into (station, chunk) groups and each group also receives copies of
the neighbouring rows it needs. Both follow from the row counts per (station, day): a
table with at most one row per calendar day, built by a map-side combined count.
A chunk ends with the day on which it has ``CHUNK_ROWS`` rows, so a station with most of all rows
is just cut into more chunks. Days are copied until the required number of rows is
surely there, also across gaps and across chunks shorter than the reach, so the
result equals the plain window exactly. There is one plan, whatever the size.

Rows without a time have no place in a series and are left out.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F

from .sizes import settled

CHUNK_ROWS = 4000


def _plan(rows, keys, before, after, chunk_rows):
    """(keys, day) -> the chunk of that day and all chunks that need its rows."""
    days = rows.groupBy(*keys, "_day").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_day")
    upto = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    days = days.withColumn("_upto", upto).withColumn("_prior", F.col("_upto") - F.col("_n"))
    days = days.withColumn("_home", F.floor(F.col("_prior") / chunk_rows))
    entry = F.struct("_home", "_prior", "_upto")
    found = [F.array("_home")]
    if before:
        later = F.collect_list(entry).over(w.rowsBetween(1, before))
        near = F.filter(later, lambda d: d["_prior"] - F.col("_upto") < before)
        found.append(F.transform(near, lambda d: d["_home"]))
    if after:
        earlier = F.collect_list(entry).over(w.rowsBetween(-after, -1))
        near = F.filter(earlier, lambda d: F.col("_prior") - d["_upto"] < after)
        found.append(F.transform(near, lambda d: d["_home"]))
    return days.select(*keys, "_day", "_home", F.array_distinct(F.concat(*found)).alias("_chunks"))


def with_halo(df, apply, *, keys=("station_id",), ts="ts", order=None, before=0, after=0, chunk_rows=CHUNK_ROWS):
    """Run ``apply(df, window)`` as if ``window`` were the whole series of each key.

    ``apply`` must look at most ``before`` rows back and ``after`` rows forward. Rows follow each other by ``ts``, or by
    ``order`` if that is another column that never falls from one day of ``ts`` to the next: a local time has
    an hour twice in autumn, and only the instant tells its readings apart.
    One shuffle of the data on (keys, chunk); the copies are a few days per chunk. The
    plan of chunks is settled first, in a job over keys and times only, so that joining
    it needs no shuffle of the data as long as that table fits a broadcast.
    """
    keys = list(keys)
    rows = df.where(F.col(ts).isNotNull()).withColumn("_day", F.to_date(ts))
    plan = settled(_plan(rows, keys, before, after, chunk_rows), "chunks")
    plan = plan.withColumnsRenamed({c: f"_at_{c}" for c in [*keys, "_day"]})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in [*keys, "_day"]])
    both = rows.join(plan, same).select(*rows.columns, "_home", F.explode("_chunks").alias("_chunk"))
    both = both.withColumn("_own", F.col("_chunk") == F.col("_home")).drop("_home")
    window = Window.partitionBy(*keys, "_chunk").orderBy(order or ts)
    return apply(both, window).where("_own").drop("_own", "_chunk", "_day")
