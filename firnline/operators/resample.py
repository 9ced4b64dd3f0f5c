"""Roll-ups of series to hours, days, weeks and months."""

from pyspark.sql import functions as F

from ..functions.periods import complete_before, hour_start, period
from ..schema import PERIOD_RULES, SENSOR_COLS, rule_name
from .sizes import settled

MEAN_ALL = {c: "mean" for c in SENSOR_COLS}
PRECIPITATION_STATION = {**MEAN_ALL, "n": "sum", "sd": "sum", "gs": "sum"}


def _aggregate(column, how):
    if how == "mean":
        return F.avg(column).alias(column)
    if how == "sum":
        return F.coalesce(F.sum(column), F.lit(0.0)).alias(column)
    raise ValueError(f"unknown aggregate {how!r}")


def resample(df, rule, how=PRECIPITATION_STATION, key="station_id", ts="ts"):
    """One row per (station, period); a sum of nothing is 0, a mean of nothing null."""
    aggs = [_aggregate(c, h) for c, h in how.items() if c in df.columns]
    return df.groupBy(key, period(ts, rule).alias("period")).agg(*aggs)


def _sums_and_counts(columns):
    return [F.sum(c).alias(f"s_{c}") for c in columns] + [F.count(c).alias(f"k_{c}") for c in columns]


def _added_up(columns):
    return [F.sum(f"{p}_{c}").alias(f"{p}_{c}") for p in ("s", "k") for c in columns]


def resample_rules(df, stations, rules=PERIOD_RULES, key="station_id", ts="ts"):
    """All rules from one pass over the cleaned frame.

    Readings are added up to sums and counts per hour once; the rules are formed from
    those, so every mean is still the mean over readings. ``stations`` has one row per
    station (key, has_n): stations with precipitation sum n, sd and gs, the others
    average everything. Both forms come from the same sums and counts, so the choice is
    made on the rolled-up rows. With a column latest_ts only periods that are over by
    then are kept.
    """
    hours = df.groupBy(key, hour_start(ts).alias("hour")).agg(*_sums_and_counts(SENSOR_COLS))
    labels = F.array(*[F.struct(F.lit(rule_name(r)).alias("rule"), period("hour", r).alias("period")) for r in rules])
    spread = hours.withColumn("_p", F.explode(labels)).select("*", "_p.rule", "_p.period")
    sums = spread.groupBy(key, "rule", "period").agg(*_added_up(SENSOR_COLS))

    def value(c):
        mean = F.try_divide(F.col(f"s_{c}"), F.col(f"k_{c}"))
        if PRECIPITATION_STATION[c] == "mean":
            return mean.alias(c)
        return F.when(F.col("has_n"), F.coalesce(F.col(f"s_{c}"), F.lit(0.0))).otherwise(mean).alias(c)

    rolled = sums.join(settled(stations, "stations"), key, "left")
    if "latest_ts" in stations.columns:
        over = F.lit(False)
        for r in rules:
            over = over | ((F.col("rule") == rule_name(r)) & (F.col("period") < complete_before("latest_ts", r)))
        rolled = rolled.where(over)
    return rolled.select(key, "rule", "period", *[value(c) for c in SENSOR_COLS])


def complete_bounds(latest, rules=PERIOD_RULES, key="station_id", ts="latest_ts"):
    """Per station and rule the exclusive end of the last complete period."""
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), complete_before(ts, r).alias("bound")) for r in rules])
    return latest.select(key, F.explode(rows).alias("_b")).select(key, "_b.*")


def only_complete(resampled, bounds, key="station_id"):
    """Keep periods that are over: hour and day labels are starts, week and month labels last days."""
    return resampled.join(bounds, [key, "rule"]).where(F.col("period") < F.col("bound")).drop("bound")


def dense_calendar(df, rule, key, ts="period"):
    """All period labels of each key between its first and last one.

    The calendar comes from one (first, last) row per key: its size is a matter of
    the time span, not of the data. Hours are spread by day first, so that a long span
    is not unrolled in one row.
    """
    unit = {"daily": "INTERVAL 1 DAY", "weekly": "INTERVAL 7 DAYS"}
    span = df.groupBy(key).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    rule = rule_name(rule)
    if rule == "monthly":
        months = F.sequence(F.trunc(F.to_date("_lo"), "MM"), F.to_date("_hi"), F.expr("INTERVAL 1 MONTH"))
        return span.select(key, F.explode(months).alias(ts)).withColumn(ts, F.last_day(ts).cast("timestamp_ntz"))
    if rule == "hourly":
        days = span.select(key, "_lo", "_hi", F.explode(F.sequence(F.to_date("_lo"), F.to_date("_hi"))).alias("_d")).repartition(key, "_d")
        hour = F.col("_d").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("_h"))
        hours = days.select(key, "_lo", "_hi", "_d", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h"))
        return hours.select(key, "_lo", "_hi", hour.alias(ts)).where(F.col(ts).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")
    return span.select(key, F.explode(F.sequence("_lo", "_hi", F.expr(unit[rule]))).alias(ts))


def resample_dense(df, rule, columns, key="site", ts="ts"):
    """Mean per period with the empty periods kept as null rows."""
    means = resample(df, rule, {c: "mean" for c in columns}, key, ts)
    return dense_calendar(means, rule, key).join(means, [key, "period"], "left")


def yearly_complete_sum(monthly, column="n", key="station_id", ts="period"):
    """Yearly sums of the years that have all twelve months."""
    return (
        monthly.groupBy(key, F.year(ts).alias("year"))
        .agg(F.coalesce(F.sum(column), F.lit(0.0)).alias(column), F.count("*").alias("months"))
        .where("months = 12")
    )


def monthly_mean_of_daily(daily, columns, key="station_id", ts="period"):
    """Daily history to month-end means; months with any missing column are left out."""
    return resample(daily, "monthly", {c: "mean" for c in columns}, key, ts).dropna("any")
