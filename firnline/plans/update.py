"""Ingest readings, keep the raw table current and rebuild the processed tables.

A delivery touches days; the reach of the cleaning steps and of the moving average, periods that have closed since and
rows that came into a station's span widen them. Only the periods these days lie in are computed
anew, from the partitions of their days and a few rows before, and put in the place of the stored ones. What to
read follows from the counts of rows per station and day that lie beside the raw table.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.periods import month_end, period, week_end
from ..operators.align import pivot_delivery
from ..operators.chunks import CHUNK_ROWS, with_halo
from ..operators.clean import SNOW_REACH, clean_series, clean_snow, instant
from ..operators.latest import station_summary
from ..operators.merge import overlay
from ..operators.moving import TRAILING_ROWS, trailing_mean
from ..operators.resample import resample_rules
from ..operators.sizes import settled
from ..schema import PERIOD_RULES, PORTAL_START, SENSOR_COLS, rule_name
from ..sources.historic import historic_wide
from ..sources.manifest import list_files, note_files, note_folders, station_files, unseen_files
from ..sources.portal import parse_portal, portal_records, rejected, with_station_id
from ..sources.store import (
    PROCESSED,
    add_facts,
    anchor,
    days_of,
    facts_of,
    known_from,
    known_stations,
    merge_raw,
    merged_facts,
    noted_facts,
    read_raw,
    read_table,
    remove_raw,
    replace_periods,
    station_facts,
    with_epoch,
    write_processed,
)
from ..sources.tables import stations

PORTAL_FIRST_YEAR = int(PORTAL_START[:4])
STEP_SECONDS = 300
MOVING_REACH = TRAILING_ROWS - 1 + SNOW_REACH


def _on_grid(step_seconds=STEP_SECONDS):
    return F.timestamp_diff("SECOND", F.col("origin"), F.col("ts_utc")) % step_seconds == 0


def _inside(raw, stations, step_seconds=STEP_SECONDS):
    """Rows on the time grid and inside the span of their station's anchor sensor."""
    inside = F.col("grid_from").isNull() | F.col("ts_utc").between(F.col("grid_from"), F.col("grid_to"))
    known = stations.select("station_id", "grid_from", "grid_to", "origin")
    return raw.join(known, "station_id").where(inside & _on_grid(step_seconds)).drop("grid_from", "grid_to", "origin")


def processed_rows(raw, rules=PERIOD_RULES, chunk_rows=CHUNK_ROWS, stations=None):
    """Cleaned complete periods of all rules from raw wide rows.

    ``stations`` (see store.known_stations) says what holds for the whole table: which stations measure
    precipitation, and the grid and span of their anchor sensor, which rows have to lie in. Without it
    the rows at hand decide. Readings follow each other by UTC time, periods are those of the local time.
    """
    if stations is None:
        stations = station_summary(raw)
    else:
        raw = _inside(raw, stations)
        stations = stations.select("station_id", "latest_ts", "has_n")
    return resample_rules(clean_series(raw, chunk_rows), stations, rules)


def _rows_of(raw):
    return raw.withColumn("station_id", F.col("station_id").cast("int")).select("station_id", "ts_utc", "ts", *SENSOR_COLS, "year", "month")


def update_processed(spark, raw_path, processed_path, from_year=None):
    """Rebuild the processed table, or from ``from_year`` on.

    Stored partitions of years after the portal's first one that turn out to have no rows any more go.
    """
    raw = _rows_of(read_raw(spark, raw_path))
    known = settled(known_stations(spark, raw_path, raw), "stations")
    if from_year is None:
        write_processed(processed_rows(raw.drop("year", "month"), stations=known), processed_path, PORTAL_FIRST_YEAR + 1)
        return
    # the week that reaches into the year, and the days before that with the rows that cleaning looks back on
    first = F.lit(f"{from_year}-01-01").cast("date")
    days = _with_halo_days(days_of(spark, raw_path).withColumn("needed", F.col("day") >= F.date_sub(first, 6)), SNOW_REACH)
    rows = processed_rows(_of_days(raw, settled(days.where("read"), "days")).drop("year", "month", "needed"), stations=known)
    write_processed(rows.where(F.year("period") >= from_year), processed_path, from_year)


def update_moving(spark, raw_path, processed_path):
    """Write the moving average of the snow height as the rule movavg; its periods are the instants, in UTC."""
    rows = moving_average(_rows_of(read_raw(spark, raw_path)))
    write_processed(_as_rule(rows), processed_path, PORTAL_FIRST_YEAR + 1)


def _as_rule(moving):
    rest = [F.lit(None).cast("double").alias(c) for c in SENSOR_COLS if c != "hs"]
    return moving.select("station_id", F.lit("movavg").alias("rule"), F.col("ts").alias("period"), "hs", *rest).select(PROCESSED)


# --- taking readings in ------------------------------------------------------------------------------

def _changed_grids(before, after, step_seconds):
    moved = F.timestamp_diff("SECOND", F.col("_origin"), F.col("origin")) % step_seconds != 0
    old = before.select("station_id", F.col("origin").alias("_origin"))
    return after.join(old, "station_id").where(moved).select("station_id", "origin")


def _regrid(spark, changed, path, step_seconds):
    """Rows of stations whose grid has moved change places between the table and the rows kept aside."""
    aside = f"{path}-off"
    out = settled(read_raw(spark, path).join(changed, "station_id").where(~_on_grid(step_seconds)).drop("origin"), "out")
    off = read_raw(spark, aside)
    back = None if off is None else settled(off.join(changed, "station_id").where(_on_grid(step_seconds)).drop("origin"), "back")
    for rows, here, there in ((back, aside, path), (out, path, aside)):
        if rows is not None and not rows.isEmpty():
            merge_raw(spark, rows.drop("year", "month"), there)
            remove_raw(spark, rows.select("station_id", "year", "month", "ts_utc"), here)


def ingest(spark, readings, raw_path, order=None, newest=False, step_seconds=STEP_SECONDS):
    """Merge new readings into the raw table without loss; returns what is off the grid, per station and reason.

    Rows are keyed by UTC time. Of copies of a reading the lowest by ``order`` wins, or the highest (``newest``), whichever
    delivery they come with, so the table is the same for any batches in any order; without ``order`` later
    deliveries win. Readings off the station's time grid, which is that of the first anchor reading known from any delivery,
    or of its first reading while there is none, are kept aside, and come back when the grid turns out to be
    another. Span limits are applied when periods are formed, so a reading outside today's span is not lost.
    """
    return _ingest(spark, _with_instant(readings), raw_path, order, newest, step_seconds)[0]


def _with_instant(readings):
    return readings if "ts_utc" in readings.columns else readings.withColumn("ts_utc", F.col("ts"))


def _ingest(spark, readings, raw_path, order, newest, step_seconds=STEP_SECONDS, facts=None):
    """ingest, and what was known of the stations before (or None) and is known now."""
    before = noted_facts(spark, raw_path)
    before = None if before is None else settled(before, "before")
    facts = settled(with_epoch(station_facts(readings) if facts is None else facts, before), "facts")
    add_facts(facts, raw_path)  # first: if the merge is lost, facts of readings that come again do no harm
    now = known_from(facts if before is None else settled(merged_facts(before.unionByName(facts)), "now"))
    wide = pivot_delivery(readings, order, newest).join(now.select("station_id", "origin"), "station_id")
    off = wide.where(~_on_grid(step_seconds)).drop("origin")
    left_out = settled(off.groupBy("station_id").agg(F.count("*").alias("records")).withColumn("reason", F.lit("off grid")), "off")
    merge_raw(spark, wide.where(_on_grid(step_seconds)).drop("origin"), raw_path)
    if not left_out.isEmpty():
        merge_raw(spark, off, f"{raw_path}-off")
    if before is None:
        return left_out, None, now
    changed = _changed_grids(known_from(before), now, step_seconds)
    if not changed.isEmpty():
        _regrid(spark, settled(changed, "changed"), raw_path, step_seconds)
    return left_out, known_from(before), now


# --- what a change touches ---------------------------------------------------------------------------

def _with_halo_days(days, reach):
    """``days`` (station_id, day, n, needed) with ``read``: needed, or among the days with the ``reach`` rows before a needed one."""
    line = Window.partitionBy("station_id").orderBy("day")
    upto = F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, 0))
    days = days.withColumn("_upto", upto)
    following = F.min(F.when(F.col("needed"), F.col("_upto") - F.col("n"))).over(line.rowsBetween(1, Window.unboundedFollowing))
    return days.withColumn("read", F.col("needed") | F.coalesce(following - F.col("_upto") < reach, F.lit(False))).drop("_upto")


def _of_days(raw, days):
    """Raw rows of the given days (settled); partitions without one are not read."""
    keyed = days.select("station_id", F.year("day").alias("year"), F.month("day").alias("month"), F.col("day").alias("_day"), "needed")
    return raw.withColumn("_day", F.to_date("ts")).join(keyed, ["station_id", "year", "month", "_day"]).drop("_day")


def _hits(days, touched, before, known):
    """``days`` of the touched stations with ``hit``: days whose rows, or their part in periods, may have changed.

    Those of the change itself; all days of a station that is new, has another grid or turns out to measure
    precipitation; days between the old and the new ends of its span; and the days of the last reading before and
    now, whose periods may have become complete.
    """
    own = touched.select("station_id").distinct()
    now = known.join(own, "station_id").select("station_id", *[F.col(c).alias(f"_{c}") for c in ("grid_from", "grid_to", "origin", "latest_ts", "has_n")])
    both = now.join(before, "station_id", "left")
    between = lambda a, b: F.when(~a.eqNullSafe(b), F.struct(F.to_date(F.least(a, b)).alias("lo"), F.to_date(F.greatest(a, b)).alias("hi")))
    both = both.select(
        "station_id",
        (F.col("latest_ts").isNull() | (F.col("has_n") != F.col("_has_n")) | (F.col("grid_from").isNull() != F.col("_grid_from").isNull())
         | (F.timestamp_diff("SECOND", F.col("origin"), F.col("_origin")) % STEP_SECONDS != 0)).alias("all"),
        between(F.col("grid_from"), F.col("_grid_from")).alias("start"), between(F.col("grid_to"), F.col("_grid_to")).alias("end"),
        F.array_compact(F.array(F.to_date("latest_ts"), F.to_date("_latest_ts"))).alias("last"))
    zero, yes = F.lit(0).cast("long").alias("n"), F.lit(True).alias("hit")
    marks = touched.select("station_id", "day", zero, yes).unionByName(both.select("station_id", F.explode("last").alias("day"), zero, yes))
    days = days.join(own, "station_id").withColumn("hit", F.lit(False)).unionByName(marks)
    days = days.groupBy("station_id", "day").agg(F.sum("n").alias("n"), F.max("hit").alias("hit")).join(both, "station_id")
    # spans are in UTC, a local day can begin up to a day off
    near = lambda r: F.coalesce(F.col("day").between(F.date_sub(F.col(r)["lo"], 1), F.date_add(F.col(r)["hi"], 1)), F.lit(False))
    return days.withColumn("hit", F.col("hit") | F.coalesce("all", F.lit(True)) | near("start") | near("end")).select("station_id", "day", "n", "hit")


def _reached(days, reach, name):
    """``name``: days with a row that looks back on a row of a hit day, itself included, at most ``reach`` rows back."""
    line = Window.partitionBy("station_id").orderBy("day")
    upto = F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, 0))
    days = days.withColumn("_upto", upto)
    last = F.max(F.when(F.col("hit"), F.col("_upto"))).over(line.rowsBetween(Window.unboundedPreceding, -1))
    return days.withColumn(name, F.col("hit") | F.coalesce(F.col("_upto") - F.col("n") - last < reach, F.lit(False))).drop("_upto")


def change_set(days, touched, before, known):
    """Per station and day: is it ``changed`` (periods), ``moving`` (moving average), and what has to be read for either.

    ``read_periods`` has all days of the touched weeks and months with the rows before that cleaning looks back on;
    ``needed`` are those without these rows, ``read_moving`` and ``moving`` the same for the moving average.
    """
    days = _reached(_reached(_hits(days, touched, before, known), SNOW_REACH, "changed"), MOVING_REACH, "moving")
    in_touched = lambda label: F.max("changed").over(Window.partitionBy("station_id", label("day")))
    days = days.withColumn("needed", in_touched(week_end) | in_touched(month_end))
    days = _with_halo_days(days, SNOW_REACH).withColumnRenamed("read", "read_periods").withColumnRenamed("needed", "_needed")
    days = _with_halo_days(days.withColumn("needed", F.col("moving")), MOVING_REACH).withColumnRenamed("read", "read_moving").drop("needed")
    return days.withColumnRenamed("_needed", "needed")


def rebuild(spark, raw_path, processed_path, touched, before, known, gone=None, rules=PERIOD_RULES):
    """Bring the processed table up to date after a change of the raw one.

    ``touched`` (station_id, day) are the local days with changed rows, ``before`` and ``known`` the known stations before the change
    (None if there was nothing) and now, ``gone`` (station_id, ts_utc) the rows that were taken out.
    """
    if before is None:
        before = known.limit(0)
    plan = settled(change_set(days_of(spark, raw_path), touched, before, known), "plan")
    raw = _rows_of(read_raw(spark, raw_path))
    changed = plan.where("changed")
    labels = F.explode(F.array(*[F.struct(F.lit(rule_name(r)).alias("rule"), _anchor_of(r).alias("anchor")) for r in rules]))
    scope = changed.select("station_id", labels.alias("_s")).select("station_id", "_s.*").distinct()
    # periods: all rows of the touched weeks and months, cleaned with the few rows before them
    rows = _inside(_of_days(raw, plan.where("read_periods")).drop("year", "month"), known)
    cleaned = clean_series(rows).where("needed")
    periods = resample_rules(cleaned, known.select("station_id", "latest_ts", "has_n"), rules).withColumn("anchor", anchor())
    periods = periods.join(scope, ["station_id", "rule", "anchor"], "left_semi").select(PROCESSED)
    moving = _of_days(raw, plan.where("read_moving").withColumn("needed", F.col("moving"))).drop("year", "month")
    moving = _as_rule(moving_average(moving))
    fresh = settled(periods.unionByName(moving), "fresh")
    scope = scope.unionByName(fresh.where("rule = 'movavg'").select("station_id", "rule", F.col("period").alias("anchor")))
    if gone is not None:
        scope = scope.unionByName(gone.select("station_id", F.lit("movavg").alias("rule"), F.col("ts_utc").alias("anchor")))
    replace_periods(spark, fresh, settled(scope.distinct(), "scope"), processed_path)


def _anchor_of(rule):
    """The anchor (see store.anchor) of the periods of a rule that a day lies in."""
    day = {"weekly": week_end("day"), "monthly": month_end("day")}.get(rule_name(rule), F.col("day"))
    return day.cast("timestamp_ntz")


FILES_PER_BATCH = 10_000


def ingest_and_rebuild(spark, readings, raw_path, processed_path, order="load_seq", newest=True):
    """Take in a delivery and rebuild the periods it touches; returns what is off the grid."""
    readings = _with_instant(readings)
    # one pass for the days that are touched and for what the stations measure
    days = settled(station_facts(readings.withColumn("day", F.to_date("ts")), "day").withColumn("epoch", F.lit(0)), "days")
    left_out, before, now = _ingest(spark, readings, raw_path, order, newest, facts=merged_facts(days).drop("epoch"))
    rebuild(spark, raw_path, processed_path, days.select(F.col("station_id").cast("int").alias("station_id"), "day"), before, now)
    return left_out


def delete_span(spark, raw_path, station_id, first, last, processed_path=None):
    """Take one station's rows of a closed range of local times out of the raw table, and out of the periods they were part of.

    Partitions left empty are removed; what the station is known to measure is found anew from the rows that stay. Readings
    that are delivered again afterwards come back.
    """
    first, last = (F.lit(t).cast("timestamp_ntz") if isinstance(t, str) else t for t in (first, last))
    taken = []
    for path in (raw_path, f"{raw_path}-off"):
        raw = read_raw(spark, path)
        if raw is None:
            continue
        within = (F.col("station_id") == station_id) & F.col("year").between(F.year(first), F.year(last)) & F.col("ts").between(first, last)
        gone = settled(raw.where(within).select("station_id", "year", "month", "ts_utc", "ts"), "gone")
        if not gone.isEmpty():
            taken.append((path, gone))
    if not taken:
        return 0
    noted = noted_facts(spark, raw_path)
    noted = settled(with_epoch(facts_of(read_raw(spark, raw_path)), None) if noted is None else noted, "before")
    for path, gone in taken:
        remove_raw(spark, gone, path)
    left = settled(with_epoch(_facts_after(spark, raw_path, station_id), noted, 1), "left")
    add_facts(left, raw_path)
    gone = reduce(DataFrame.unionByName, [g for _, g in taken])
    if processed_path is not None:
        touched = gone.select(F.col("station_id").cast("int").alias("station_id"), F.to_date("ts").alias("day")).distinct()
        now = settled(noted.where(F.col("station_id") != station_id).unionByName(left.select(noted.columns)), "now")
        rebuild(spark, raw_path, processed_path, touched, known_from(noted), known_from(now), gone.select(F.col("station_id").cast("int").alias("station_id"), "ts_utc"))
    return gone.count()


def _facts_after(spark, raw_path, station_id):
    """Facts of a station from its rows, on the grid or aside; without rows it knows nothing but its number."""
    tables = [t for t in (read_raw(spark, raw_path), read_raw(spark, f"{raw_path}-off")) if t is not None]
    rows = reduce(DataFrame.unionByName, tables).where(F.col("station_id") == station_id)
    none = spark.createDataFrame([(station_id,)], "station_id int")
    found = facts_of(rows.withColumn("station_id", F.col("station_id").cast("int")))
    return none.join(found, "station_id", "left").withColumn("has_n", F.coalesce("has_n", F.lit(False)))


def update_all(spark, json_path, raw_path, processed_path, manifest_path, files_per_batch=FILES_PER_BATCH):
    """Take in the files not seen before and rebuild what they touch; returns their number.

    Folders in which nothing has changed are not compared. A batch has a bounded number of files, which is all the driver
    ever holds; in which order batches come does not matter. Records that were not taken are counted in a table
    beside the raw one.
    """
    files = station_files(list_files(spark, json_path, times=True))
    unseen, folders = unseen_files(spark, files, manifest_path)
    names, taken = stations(spark), 0
    parts = -(-unseen.count() // files_per_batch)
    for part in range(parts):
        share = unseen.where(F.pmod(F.xxhash64("path"), F.lit(parts)) == part) if parts > 1 else unseen
        paths = sorted(r["path"] for r in share.collect())  # about files_per_batch
        for start in range(0, len(paths), files_per_batch):
            batch = paths[start : start + files_per_batch]
            records = portal_records(spark, batch)
            readings = with_station_id(parse_portal(records), names)
            off_grid = ingest_and_rebuild(spark, readings, raw_path, processed_path)
            left_out = rejected(records, names).unionByName(off_grid, allowMissingColumns=True)
            left_out.write.mode("append").parquet(f"{raw_path}-rejects")
            note_files(spark.createDataFrame([(p,) for p in batch], "path string"), manifest_path)
            taken += len(batch)
    note_folders(folders, manifest_path)
    return taken


def moving_average(raw, chunk_rows=CHUNK_ROWS):
    """Trailing mean of the cleaned snow height: cleaning and mean in one pass over the chunks.

    Rows follow each other by UTC time where they have it, and ``ts`` of the result is that instant. Rows that are
    there for their neighbours only, with ``needed`` false, are left out.
    """
    order = instant(raw)

    def run(rows, window):
        return trailing_mean(clean_snow(rows, window), "hs", window, "hs_mean")

    columns = [*dict.fromkeys(["station_id", order, "ts", "hs", "lt"]), *[c for c in ("needed",) if c in raw.columns]]
    out = with_halo(raw.select(columns), run, order=order, before=MOVING_REACH, chunk_rows=chunk_rows)
    if "needed" in raw.columns:
        out = out.where("needed")
    return out.select("station_id", F.col(order).alias("ts"), F.col("hs_mean").alias("hs"))


def history_rows(parsed):
    """Processed rows of the historic files; months are overlaid with the means of the days."""
    wide = historic_wide(parsed).withColumn("period", F.col("date").cast("timestamp_ntz"))
    keys = ["station_id", "period"]
    daily = wide.where("resolution = 'daily'").select(*keys, *SENSOR_COLS)
    monthly = wide.where("resolution = 'monthly'").select(*keys, *SENSOR_COLS)
    return daily.withColumn("rule", F.lit("daily")).unionByName(
        overlay_months(monthly, daily).withColumn("rule", F.lit("monthly"))
    ).select(*PROCESSED)


def overlay_months(monthly, daily, columns=SENSOR_COLS):
    """Monthly means of the days put over the existing months; no month is added.

    Months in which a column the station measures is null throughout are left out of
    the overlay.
    """
    keys = ["station_id", "period"]
    measured = daily.groupBy("station_id").agg(*[(F.count(c) > 0).alias(f"_has_{c}") for c in columns])
    means = daily.groupBy("station_id", period("period", "monthly").alias("period")).agg(
        *[F.avg(c).alias(c) for c in columns]
    )
    whole = None
    for c in columns:
        ok = ~F.col(f"_has_{c}") | F.col(c).isNotNull()
        whole = ok if whole is None else whole & ok
    means = means.join(measured, "station_id").where(whole).select(*keys, *columns)
    return overlay(monthly, means, keys, columns, "left")


def load_history(parsed, processed_path):
    write_processed(history_rows(parsed), processed_path)

