"""Joined frames behind the charts: springs, lakes, snow and isotopes."""

from pyspark.sql import functions as F

from ..functions.hydro import lake_volume, water_line
from ..functions.periods import WINTER_PANEL_MONTHS, winter_label
from ..operators.chunks import CHUNK_ROWS, with_halo
from ..operators.clean import CONDUCTIVITY_REACH, clean_conductivity, zero_periods
from ..operators.filters import open_clip, seasons, without_snowless
from ..operators.fit import linear_regression
from ..operators.moving import centre_reach, centred_mean
from ..operators.resample import resample_dense, yearly_complete_sum
from ..operators.season import accumulate, in_season, pair_with_winter, season_maximum, yearly_maxima
from ..schema import STATION_ID, rule_name
from .lakes import within_span

# --- fixed values: winters without usable data, and the last start year -----
SKIPPED_WINTERS = (2001, 2002)
FIRST_WINTER, LAST_WINTER = 1998, 2019
WINDOW_MIN_SHARE = 1.5


def station_rows(processed, station_id, rule, *columns):
    return processed.where((F.col("station_id") == station_id) & (F.col("rule") == rule_name(rule))).select(
        "period", *columns
    )


def _beside(rows, logger, left=None, right=None, key="site"):
    """Rows of one station beside each logger: from its first to its last day at midnight, then clipped.

    The span of a logger is spread to its days, so rows meet it in an equi-join on the day.
    """
    span = logger.groupBy(key).agg(F.min("period").alias("_lo"), F.max("period").alias("_hi"))
    days = span.select(key, "_lo", "_hi", F.explode(F.sequence(F.to_date("_lo"), F.to_date("_hi"))).alias("_day"))
    here = rows.withColumn("_day", F.to_date("period")).join(days, "_day")
    here = here.where(F.col("period").between(F.date_trunc("day", "_lo").cast("timestamp_ntz"), F.date_trunc("day", "_hi").cast("timestamp_ntz")))
    return _open(here, left, right).drop("_day", "_lo", "_hi")


def _open(rows, left, right):
    """Open interval; an open end falls back to the span of the logger (_lo, _hi)."""
    lo = F.lit(left).cast("timestamp_ntz") if left else F.col("_lo")
    hi = F.lit(right).cast("timestamp_ntz") if right else F.col("_hi")
    return rows.where((F.col("period") > lo) & (F.col("period") < hi))


def _clip_each(rows, logger, left, right, key="site"):
    span = logger.groupBy(key).agg(F.min("period").alias("_lo"), F.max("period").alias("_hi"))
    return _open(rows.join(span, key), left, right).drop("_lo", "_hi")


def _by_days(df, other):
    """Rows between the first and last day of ``other``, both at midnight."""
    days = other.select(F.to_date("period").cast("timestamp_ntz").alias("period"))
    return within_span(df, days, "period", "period")


def _clip(df, left, right, span):
    """Open interval; an open end falls back to the span of the logger."""
    lo = F.lit(left).cast("timestamp_ntz") if left else span.agg(F.min("period")).scalar()
    hi = F.lit(right).cast("timestamp_ntz") if right else span.agg(F.max("period")).scalar()
    return open_clip(df, "period", lo, hi)


def _smoothed(df, key, columns, width, least, clean=False, chunk_rows=CHUNK_ROWS):
    """Optional conductivity cleaning and centred means of several columns in one pass."""
    before, after = centre_reach(width)

    def run(rows, window):
        if clean:
            rows = clean_conductivity(rows, window)
        for c in columns:
            rows = centred_mean(rows, c, window, f"{c}_rol", width, least)
        return rows

    reach = CONDUCTIVITY_REACH if clean else 0
    return with_halo(df, run, keys=(key,), ts="period", before=before + reach, after=after, chunk_rows=chunk_rows)


def spring_panel(spring, processed, rule, left=None, right=None, station=STATION_ID["Wolkenstein"], roll=24):
    """Temperature and conductance of each spring with precipitation; smoothed when hourly."""
    rule = rule_name(rule)
    logger = resample_dense(spring, rule, ["wt", "slt"])
    rain = _beside(station_rows(processed, station, rule, "n"), logger, left, right)
    if rule == "hourly":
        shown = _smoothed(logger, "site", ["slt", "wt"], roll, None)
    else:
        shown = logger
    return _clip_each(shown, logger, left, right).join(rain, ["site", "period"], "full_outer")


def spring_snow_panel(spring, processed, rule, left=None, right=None, station=STATION_ID["Wolkenstein"],
                      snow_station=STATION_ID["Rossalm"], roll=24, clean=False):
    """spring_panel with snow height and air temperature; smoothing needs two thirds of a frame."""
    rule = rule_name(rule)
    least = int(roll / WINDOW_MIN_SHARE)
    logger = resample_dense(spring, rule, ["wt", "slt"])
    rain = _beside(station_rows(processed, station, rule, "n"), logger, left, right)
    # smoothed over the whole days of the logger, clipped afterwards
    snow = _beside(station_rows(processed, snow_station, rule, "hs", "lt"), logger, "0001-01-01", "9999-12-31")
    if rule == "hourly":
        shown = _smoothed(logger, "site", ["slt", "wt"], roll, least, clean)
        snow = _smoothed(snow, "site", ["hs", "lt"], roll, least)
    elif clean:
        shown = _smoothed(logger, "site", [], 1, None, True)
    else:
        shown = logger
    return (
        _clip_each(shown, logger, left, right)
        .join(rain, ["site", "period"], "full_outer")
        .join(_clip_each(snow, logger, left, right), ["site", "period"], "full_outer")
    )


def lake_level_panel(logger, processed, rule="daily", left=None, right=None, station=STATION_ID["Wolkenstein"],
                     columns=("wd",), lower="lower", upper="upper"):
    """Level of the lower and upper logger (column ``site``) with precipitation."""
    rows = resample_dense(logger, rule, list(columns))
    low = rows.where(F.col("site") == lower).select("period", *[F.col(c).alias(f"{c}_{lower}") for c in columns])
    high = rows.where(F.col("site") == upper).select("period", *[F.col(c).alias(f"{c}_{upper}") for c in columns])
    rain = _by_days(station_rows(processed, station, rule, "n"), low)
    out = _clip(low, left, right, low)
    for part in (high, rain):
        out = out.join(_clip(part, left, right, low), "period", "full_outer")
    return out


def lake_volume_panel(logger, processed, lake, rule="daily", left=None, right=None,
                      station=STATION_ID["Wolkenstein"]):
    """Volume from the level of each logger with precipitation; ``lake`` is a lake or {site: lake}."""
    lakes = {lake: lake} if isinstance(lake, str) else lake
    names = F.create_map(*[F.lit(x) for pair in lakes.items() for x in pair])
    of = F.lit(lake) if isinstance(lake, str) else F.try_element_at(names, F.col("site"))
    rows = resample_dense(logger, rule, ["wd"]).withColumn("lake", of).withColumn("vol", lake_volume("lake", "wd"))
    rain = _beside(station_rows(processed, station, rule, "n"), rows, left, right)
    shown = _clip_each(rows.select("site", "period", "wd", "vol"), rows, left, right).join(rain, ["site", "period"], "full_outer")
    return shown.withColumn("lake", of).select("site", "lake", "period", "wd", "vol", "n")


def snow_monthly(processed, snow_stations=(STATION_ID["Rossalm"], STATION_ID["Piz La Ila"]),
                 station=STATION_ID["Wolkenstein"]):
    """Monthly snow heights with the precipitation of the year where all its months exist."""
    monthly = processed.where("rule = 'monthly'")
    years = yearly_complete_sum(monthly.where(F.col("station_id") == station)).select("year", F.col("n").alias("n_year"))
    snow = monthly.where(F.col("station_id").isin(*snow_stations)).select(
        "station_id", "period", F.year("period").alias("year"), "hs"
    )
    return snow.join(years, "year", "left").select("station_id", "period", "hs", "n_year")


def accumulation(swe, column, first=None, last=None):
    """Seasonal rise of ``swe`` or ``hs`` from October to June."""
    rows = in_season(swe)
    if first is not None:
        rows = rows.where(F.col("season") >= first)
    if last is not None:
        rows = rows.where(F.col("season") <= last)
    return accumulate(rows, column)


def volume_with_accumulation(lake_calc, daily, swe, lake, column, station=STATION_ID["Wolkenstein"],
                             snow_station=STATION_ID["Rossalm"], first="2014-10-01", last="2020-06-01"):
    """Measured and calculated volume, precipitation and accumulated snow of each day."""
    span = F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    volume = lake_calc.where(F.col("lake") == lake).select("date", "volume", "vol_calc")
    rain = daily.where((F.col("station_id") == station) & span).select("date", "n")
    snow = accumulation(swe.where((F.col("station_id") == snow_station) & span), column).select("date", "season", "cum")
    return volume.join(rain, "date", "full_outer").join(snow, "date", "full_outer")


def volume_and_snow(lake_calc, swe, lake, column, snow_station=STATION_ID["Rossalm"], before_year=2020):
    """Largest lake volume of each year next to the largest accumulation of the winter before."""
    volume = yearly_maxima(lake_calc.where((F.col("lake") == lake) & (F.year("date") < before_year)))
    snow = accumulation(swe.where(F.col("station_id") == snow_station), column, last=before_year - 1)
    return pair_with_winter(volume, season_maximum(snow)).select("year", "season", "max_vol", "max_cum")


def volume_snow_regression(lake_calc, swe, lake, column, **kw):
    """Line of accumulation over volume: slope, intercept, r2, pairs."""
    return linear_regression(volume_and_snow(lake_calc, swe, lake, column, **kw), "max_vol", "max_cum")


def winter_panels(processed, rule, overrides=None, stations=(STATION_ID["Rossalm"], STATION_ID["Piz La Ila"]),
                  first=FIRST_WINTER, last=LAST_WINTER, skip=SKIPPED_WINTERS):
    """Snow height by station, winter and date (September to July); missing snow counts as 0.

    Daily panels leave out winters without snow and set the override periods to 0.
    """
    rule = rule_name(rule)
    rows = processed.where((F.col("rule") == rule) & F.col("station_id").isin(*stations)).select(
        "station_id", F.to_date("period").alias("date"), F.coalesce("hs", F.lit(0.0)).alias("hs")
    )
    rows = seasons(rows, "date", WINTER_PANEL_MONTHS, first, last, skip)
    if rule == "daily":
        rows = without_snowless(rows)
        if overrides is not None:
            rows = zero_periods(rows, overrides, "hs")
    return rows.withColumn("winter", winter_label("season"))


def panel_keys(panels):
    """Winters that any of the stations has."""
    return panels.select("season", "winter").distinct()


def isotope_view(samples, site):
    """Samples of one site with error bars and the meteoric water line at their d18O."""
    return samples.where(F.col("site") == site).select(
        "date", "d18o", "d2h",
        (F.col("d18o") - F.col("d18o_sd")).alias("d18o_lo"), (F.col("d18o") + F.col("d18o_sd")).alias("d18o_hi"),
        (F.col("d2h") - F.col("d2h_sd")).alias("d2h_lo"), (F.col("d2h") + F.col("d2h_sd")).alias("d2h_hi"),
        water_line("d18o").alias("line"), water_line("d18o", 2).alias("line_lo"), water_line("d18o", 18).alias("line_hi"),
    )


def water_line_grid(first, last, step=0.1):
    """Expression: array of (x, line, line_lo, line_hi) from first to last in even steps."""
    n = F.ceil((last - first) / step).cast("int")
    x = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: first + i * step)
    return F.transform(x, lambda v: F.struct(
        v.alias("x"), water_line(v).alias("line"), water_line(v, 2).alias("line_lo"), water_line(v, 18).alias("line_hi")
    ))


def isotopes_by_date(samples, without=None):
    """d18O of all sites by date with its error bar; one site may be left out."""
    rows = samples if without is None else samples.where(F.col("site") != without)
    return rows.select(
        "site", "date", "d18o",
        (F.col("d18o") - F.col("d18o_sd")).alias("d18o_lo"), (F.col("d18o") + F.col("d18o_sd")).alias("d18o_hi"),
    )


def sites(samples):
    return samples.select("site").distinct()
