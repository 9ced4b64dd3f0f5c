"""Calendar expressions: period labels, completeness bounds, seasons.

Everything works on TIMESTAMP_NTZ / DATE, so the session time zone plays no role.
"""

from pyspark.sql import functions as F

from ..schema import rule_name

ACCUMULATION_MONTHS = (10, 11, 12, 1, 2, 3, 4, 5, 6)
WINTER_PANEL_MONTHS = (9, 10, 11, 12, 1, 2, 3, 4, 5, 6, 7)
EVAPORATION_MONTHS = (6, 7, 8, 9, 10)


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def hour_start(ts):
    ts = _col(ts)
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def week_end(ts):
    """The Sunday that closes the Monday-to-Sunday week of ``ts``."""
    return F.next_day(F.date_sub(F.to_date(_col(ts)), 1), "SU")


def week_start(ts):
    return F.date_sub(F.next_day(F.to_date(_col(ts)), "MO"), 7)


def month_end(ts):
    return F.last_day(F.to_date(_col(ts)))


def period(ts, rule):
    """Label of the period holding ``ts``: start of hour/day, end of week/month."""
    rule = rule_name(rule)
    if rule == "hourly":
        return hour_start(ts)
    day = {"daily": F.to_date(_col(ts)), "weekly": week_end(ts), "monthly": month_end(ts)}[rule]
    return day.cast("timestamp_ntz")


def complete_before(latest_ts, rule):
    """Exclusive bound: readings before it belong to periods that are over."""
    rule = rule_name(rule)
    if rule == "hourly":
        return hour_start(latest_ts)
    day = F.to_date(_col(latest_ts))
    start = {"daily": day, "weekly": week_start(latest_ts), "monthly": F.trunc(day, "MM")}[rule]
    return start.cast("timestamp_ntz")


def season_start_year(d, first_month):
    """Year in which the season holding ``d`` began, for seasons that open in ``first_month``."""
    d = _col(d)
    return F.year(d) - F.when(F.month(d) < first_month, 1).otherwise(0)


def in_months(d, months):
    return F.month(_col(d)).isin(*months)


def winter_label(start_year):
    """Winter_98_99 for the winter that begins in 1998."""
    y = _col(start_year)

    def two_digits(x):
        return F.lpad((F.pmod(x, F.lit(100))).cast("string"), 2, "0")

    return F.concat_ws("_", F.lit("Winter"), two_digits(y), two_digits(y + 1))
