"""Text to number and date; bad input becomes null instead of an error."""

from pyspark.sql import functions as F

from ..schema import MISSING_MARK


def decimal_comma(text):
    """'21,8' -> 21.8; the missing mark and anything unreadable -> null."""
    t = F.col(text) if isinstance(text, str) else text
    t = F.nullif(F.trim(t), F.lit(MISSING_MARK))
    return F.replace(t, F.lit(","), F.lit(".")).try_cast("double")


def date_of(text, pattern):
    t = F.col(text) if isinstance(text, str) else text
    return F.to_date(F.try_to_timestamp(t, F.lit(pattern)))


def portal_local_time(text):
    """Local wall time of a portal time stamp such as 2020-05-07T00:00:00CEST."""
    return F.substring(text, 1, 19).try_cast("timestamp_ntz")


def portal_utc_time(text):
    """The same instant in UTC; orders the two readings that share a local hour in autumn."""
    hours = F.when(F.endswith(F.col(text), F.lit("CEST")), 2).when(F.endswith(F.col(text), F.lit("CET")), 1).otherwise(0)
    return portal_local_time(text) - F.make_dt_interval(F.lit(0), hours)


def portal_time_text(ts, zone):
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(zone))


def no_nan(c):
    """NaN compares above every number in Spark, so it is turned into null at the edge."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)
