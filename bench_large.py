"""Seconds to clean and average a long table in which one station has 80 % of the rows.

python bench_large.py [rows] compares chunks of the usual size with one chunk per station, which is
what a plain window over the station would do.
"""

import json
import sys
import time

from pyspark.sql import functions as F

from firnline.operators.chunks import CHUNK_ROWS
from firnline.plans.update import moving_average
from firnline.session import build_session


def table(spark, rows):
    """Ten-minute readings: four in five of station 1, the rest of stations 2 to 6."""
    i = F.col("id")
    station = F.when(i % 5 < 4, 1).otherwise(2 + (i / 5).cast("long") % 5).cast("int")
    ts = F.timestamp_seconds(i * 750 + 946_684_800).cast("timestamp_ntz")
    noise = F.pmod(F.xxhash64("id"), F.lit(640)) / 64
    return spark.range(0, rows, 1, 64).select(station.alias("station_id"), ts.alias("ts"), (40 + noise).alias("hs"), (noise - 6).alias("lt"))


def main():
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 25_000_000
    spark = build_session("bench-large", "local[8]", 64)
    spark.sparkContext.setLogLevel("ERROR")
    out = {"rows": rows}
    for name, chunk_rows in (("warm", CHUNK_ROWS), ("chunks", CHUNK_ROWS), ("whole", 1 << 60)):
        start = time.perf_counter()
        n = moving_average(table(spark, rows), chunk_rows).agg(F.count("hs")).first()[0]
        out[name] = {"seconds": round(time.perf_counter() - start, 1), "values": n}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
