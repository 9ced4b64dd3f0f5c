"""Weather-portal files: one JSON array per station, sensor and date span."""

from pyspark.sql import functions as F

from ..functions.text import no_nan, portal_local_time, portal_utc_time
from ..schema import PORTAL_JSON, SENSORS

# file names read station_SENSOR_from_YYYYMMDD_to_YYYYMMDD


def _parts(file_name):
    """Station and sensor of a file name, and whether it is one of a portal file."""
    head = F.substring_index(file_name, "_from_", 1)
    sensor = F.substring_index(head, "_", -1)
    station = F.substr(head, F.lit(1), F.length(head) - F.length(sensor) - 1)
    return station, sensor, sensor.isin(*SENSORS) & F.contains(F.col(file_name), F.lit("_from_"))


def parse_portal(records, file_name="file_name"):
    """(file_name, DATE, VALUE) -> readings with local time, UTC time and station name.

    Cut with plain string functions, as this runs for every reading. A column load_seq, the
    sequence of deliveries, goes along. Records left out here are those of ``rejected``.
    """
    station, sensor, named = _parts(file_name)
    return records.where(named).select(
        station.alias("station"), sensor.alias("sensor"),
        portal_local_time("DATE").alias("ts"),
        portal_utc_time("DATE").alias("ts_utc"),
        no_nan("VALUE").alias("value"),
        *[c for c in ("load_seq",) if c in records.columns],
    ).where(F.col("ts").isNotNull())


def rejected(records, stations, file_name="file_name"):
    """How many records of each file do not become readings, and why."""
    station, _, named = _parts(file_name)
    known = stations.select(F.col("station_name").alias("_station"), F.lit(True).alias("_known"))
    rows = records.withColumn("_station", station).withColumn("_named", named).join(known, "_station", "left")
    reason = F.when(~F.col("_named"), "file name").when(portal_local_time("DATE").isNull(), "time").when(F.col("_known").isNull(), "station")
    return rows.groupBy(F.col(file_name).alias("file_name"), reason.alias("reason")).agg(F.count("*").alias("records")).where("reason IS NOT NULL")


def plain_file_name():
    """Name of the file a row came from; Spark reports it URL-encoded (blanks as %20).

    A delivery may also be a folder of part files; then it is the name of the folder, which may be
    written as column=name.
    """
    own, path = F.col("_metadata.file_name"), F.col("_metadata.file_path")
    folder = F.substring_index(F.substring_index(F.substring_index(path, "/", -2), "/", 1), "=", -1)
    name = F.when(F.startswith(own, F.lit("part-")), folder).otherwise(own)
    # a folder name is encoded once by the table writer and once more by the path
    decode = lambda c: F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.when(F.startswith(own, F.lit("part-")), decode(decode(name))).otherwise(decode(name))


def with_load(files):
    """File name and load sequence of each record.

    The sequence orders deliveries by the time the file was written; files of one millisecond
    are told apart by their path, so the order does not depend on how rows come in.
    """
    written = F.unix_millis("_metadata.file_modification_time") * 65536
    return files.withColumns({"file_name": plain_file_name(), "load_seq": written + F.pmod(F.xxhash64("_metadata.file_path"), F.lit(65536))})


def portal_records(spark, path):
    """Records of all files under ``path`` (a path, a glob or a list of paths)."""
    files = spark.read.schema(PORTAL_JSON).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path)
    return with_load(files)


def read_portal_json(spark, path):
    """Readings of all files under ``path``."""
    return parse_portal(portal_records(spark, path))


def with_station_id(readings, stations):
    """Replace the station name by its id; readings of unknown stations are left out."""
    return readings.join(stations.select("station_id", F.col("station_name").alias("station")), "station").drop("station")
