"""Parquet tables of raw and processed rows, rewritten per (station, year, month) or (rule, station, year).

A raw row is keyed by station and UTC time; partitions follow its local time. Each of its cells carries the
sequence number of the delivery it came with, and of two values of a cell the one with the higher number
stays, of equal numbers the higher value. That choice is associative and commutative, so the
table does not depend on how deliveries are cut into batches or in which order those are merged.

A change writes the new content of the touched partitions to a side folder, and beside it which of them are empty
now, and marks that; only then are they moved over and the empty ones removed. When driver or executors are
lost in between, the next change finds the mark and finishes the move. Rows are sorted by
time within files, so a scan of a few days reads few row groups.

Beside the raw table lie the number of rows per station and day, from which a rebuild knows what to
read, and one row per station and delivery on what the station measures. Neither needs a scan of the table.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..operators.sizes import settled
from ..schema import SENSOR_COLS

PROCESSED = ["station_id", "rule", "period", *SENSOR_COLS]
RAW_PARTS = ["station_id", "year", "month"]
RULE_PARTS = ["rule", "station_id", "year"]
SEQ_COLS = [f"{c}_seq" for c in SENSOR_COLS]
RAW = ["station_id", "ts_utc", "ts", *SENSOR_COLS, *SEQ_COLS]
ORDER = {"raw": "ts_utc", "processed": "period"}
NO_SEQ = -(1 << 63)


def read_table(spark, path):
    """The table, or None when nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_raw(spark, path):
    """The raw table with all its columns; sequence numbers that older files lack are null."""
    table = read_table(spark, path)
    if table is None:
        return None
    schema = table.schema
    for c in SEQ_COLS:
        if c not in schema.names:
            schema = schema.add(c, "long")
    # year and month as stored, not from the time, else no partition could be skipped
    return _complete(spark.read.schema(schema).parquet(path), None).select(*RAW, "year", "month")


def _partitioned_write(df, path, mode, columns, order, grouped=False):
    # rebalance groups rows by partition but lets AQE split a partition that is too large for one task
    (
        (df if grouped else df.hint("rebalance", *columns)).sortWithinPartitions(*columns, order).write.mode(mode)
        .option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
    )


def placed(wide, seq=None):
    """Raw rows with their partition; rows that know no UTC time are keyed by the local one.

    Sensors they lack are null, and values without a sequence number get ``seq``.
    """
    return _complete(wide, seq).select(*RAW, F.year("ts").alias("year"), F.month("ts").alias("month"))


def _complete(wide, seq):
    rows = wide if "ts_utc" in wide.columns else wide.withColumn("ts_utc", F.col("ts"))
    rows = rows.withColumns({c: F.lit(None).cast("double") for c in SENSOR_COLS if c not in rows.columns})
    return rows.withColumns({f"{c}_seq": F.when(F.col(c).isNotNull(), F.lit(seq).cast("long")) for c in SENSOR_COLS if f"{c}_seq" not in rows.columns})


def write_raw(wide, path, mode="append"):
    """Append rows as they are, or replace the partitions they fall into."""
    rows = placed(wide)
    _partitioned_write(rows, path, mode, RAW_PARTS, ORDER["raw"])
    spark = wide.sparkSession
    _count_days(touched(rows, spark.read.schema(rows.schema).parquet(path), RAW_PARTS), path)


def touched(df, stored, columns):
    """Stored rows in the partitions ``df`` falls into.

    The list of partitions is settled, so the scan of the others is skipped at run time
    and its size is known to the join.
    """
    return _in(stored, settled(df.select(*columns).distinct(), "touched"), list(columns))


def _in(stored, parts, columns):
    # the comparison is true of all; Spark skips partitions at run time only where the other side is filtered
    return stored.join(parts.where("year > 0"), columns, "left_semi")


def overlay_newest(old, new, keys):
    """Rows of both; of two values of a cell that with the higher sequence number stays, of equal numbers the higher value."""
    renamed = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in ("ts", *SENSOR_COLS, *SEQ_COLS)])
    both = old.join(renamed, list(keys), "full_outer")
    cells = []
    for c in SENSOR_COLS:
        mine, theirs = F.coalesce(f"{c}_seq", F.lit(NO_SEQ)), F.coalesce(f"_new_{c}_seq", F.lit(NO_SEQ))
        later = F.col(f"_new_{c}").isNotNull() & (F.col(c).isNull() | (theirs > mine) | ((theirs == mine) & (F.col(f"_new_{c}") > F.col(c))))
        cells += [F.when(later, F.col(f"_new_{x}")).otherwise(F.col(x)).alias(x) for x in (c, f"{c}_seq")]
    return both.select(*keys, F.least("ts", "_new_ts").alias("ts"), *cells)


# --- marks and moves ---------------------------------------------------------------------------------

def _folder(spark, path):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _exists(spark, path):
    fs, at = _folder(spark, path)
    return fs.exists(at)


def _mark(spark, path, step, state):
    """Leave an empty file named after the step and its state; a finished step takes the place of all before it."""
    fs, at = _folder(spark, f"{path}-log/{step:012d}.{state}")
    fs.create(at, True).close()
    if state == "done":
        for f in fs.listStatus(at.getParent()):
            if f.getPath().getName() != at.getName():
                fs.delete(f.getPath(), False)


def _last_mark(spark, path):
    """Number and state of the last change."""
    fs, at = _folder(spark, f"{path}-log")
    if not fs.exists(at):
        return 0, "done"
    names = sorted(f.getPath().getName() for f in fs.listStatus(at))
    done = [n for n in names if n.endswith(".done")]
    step, state = (names or ["0.done"])[-1].split(".")
    return int(step), "done" if f"{step}.done" in done else state


def _count_days(rows, path):
    """Rows per station and local day in the partitions of ``rows``, beside the table."""
    days = rows.groupBy(*RAW_PARTS, F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    days.repartition(*RAW_PARTS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RAW_PARTS).parquet(f"{path}-days")


def days_of(spark, path):
    """(station_id, day, n): rows of the raw table per station and local day."""
    if not _exists(spark, f"{path}-days"):
        _count_days(read_raw(spark, path), path)
    return spark.read.schema("day date, n long, station_id int, year int, month int").parquet(f"{path}-days").select("station_id", "day", "n")


def _move(spark, path, schema, parts, kind):
    # the schema is given: a change may leave nothing, and then there is no file to read it from
    rows = spark.read.schema(schema).parquet(f"{path}-side")
    _partitioned_write(rows, path, "overwrite", parts, ORDER[kind], grouped=True)  # the files of the side folder are one partition each
    if kind == "raw":
        _count_days(rows, path)
    if not _exists(spark, f"{path}-emptied"):
        return
    for row in spark.read.parquet(f"{path}-emptied").toLocalIterator():  # partitions, of a deletion mostly
        name = "/".join(f"{c}={row[c]}" for c in parts)
        for table in (path, f"{path}-days"):
            fs, at = _folder(spark, f"{table}/{name}")
            fs.delete(at, True)


def finish_merge(spark, path, kind="raw"):
    """Finish a move that was marked but not ended; returns the number of the last change."""
    step, state = _last_mark(spark, path)
    if state == "ready":
        parts = RAW_PARTS if kind == "raw" else RULE_PARTS
        stored = read_raw(spark, path) if kind == "raw" else read_table(spark, path)
        _move(spark, path, stored.schema, parts, kind)
        _mark(spark, path, step, "done")
    return step


def _replace(spark, path, content, parts, step, kind):
    """Make ``content`` the content of the partitions ``parts`` (settled), without a moment in which rows are lost.

    Without ``parts`` the change leaves no partition empty.
    """
    columns = RAW_PARTS if kind == "raw" else RULE_PARTS
    # the side folder holds this change only
    content.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*columns).parquet(f"{path}-side")
    fs, emptied = _folder(spark, f"{path}-emptied")
    fs.delete(emptied, True)
    if parts is not None:
        filled = spark.read.schema(content.schema).parquet(f"{path}-side").select(*columns).distinct()
        parts.join(filled, columns, "left_anti").write.parquet(f"{path}-emptied")
    _mark(spark, path, step, "ready")
    _move(spark, path, content.schema, columns, kind)
    _mark(spark, path, step, "done")


def merge_raw(spark, wide, path):
    """Merge wide rows into the stored ones cell by cell and rewrite the touched partitions.

    Values without sequence numbers count as later than all merged before without them.
    """
    step = finish_merge(spark, path) + 1
    new, stored = placed(wide, step), read_raw(spark, path)
    if stored is None:
        write_raw(placed(wide, 0), path, "overwrite")
        return
    stored = stored.withColumn("station_id", F.col("station_id").cast(new.schema["station_id"].dataType))
    parts = settled(new.select(*RAW_PARTS).distinct(), "touched")
    merged = overlay_newest(_in(stored, parts, RAW_PARTS), new, [*RAW_PARTS, "ts_utc"])
    _replace(spark, path, merged.select(*RAW, "year", "month"), None, step, "raw")


def remove_raw(spark, gone, path):
    """Take the rows with the keys ``gone`` (station_id, ts_utc, year, month) out of the table; partitions left empty go."""
    step = finish_merge(spark, path) + 1
    parts = settled(gone.select(*RAW_PARTS).distinct(), "touched")
    rest = _in(read_raw(spark, path), parts, RAW_PARTS).join(gone.select(*RAW_PARTS, "ts_utc"), [*RAW_PARTS, "ts_utc"], "left_anti")
    _replace(spark, path, rest.select(*RAW, "year", "month"), parts, step, "raw")


def delete_range(wide, station_id, first, last, ts="ts"):
    """Rows outside one station's closed time range. To take rows out of the table see plans.update.delete_span."""
    inside = (F.col("station_id") == station_id) & F.col(ts).between(first, last)
    return wide.where(~inside)


# --- what stations measure ---------------------------------------------------------------------------

ANCHORS = ("lt", "sd")


def _facts(spans):
    """Aggregates (first and last UTC time, last local time) per anchor sensor and of all rows."""
    out = []
    for name, hit in spans.items():
        out += [F.min(F.when(hit, F.col("ts_utc"))).alias(f"{name}_from"), F.max(F.when(hit, F.col("ts_utc"))).alias(f"{name}_to"), F.max(F.when(hit, F.col("ts"))).alias(f"{name}_last")]
    return out


def station_facts(readings, *more):
    """What each station of a delivery measures: spans of the anchor sensors and of all, precipitation or not."""
    spans = {a: F.col("sensor") == a.upper() for a in ANCHORS} | {"any": F.lit(True)}
    rained = F.count(F.when(F.col("sensor") == "N", F.col("value"))) > 0
    return readings.groupBy("station_id", *more).agg(*_facts(spans), rained.alias("has_n"))


def facts_of(raw):
    """The same from stored rows."""
    spans = {a: F.col(a).isNotNull() for a in ANCHORS} | {"any": F.lit(True)}
    return raw.groupBy("station_id").agg(*_facts(spans), (F.count("n") > 0).alias("has_n"))


_ENDS = [f"{a}_{end}" for a in (*ANCHORS, "any") for end in ("from", "to", "last")]
NOTES = ", ".join(["station_id int", *[f"{c} timestamp_ntz" for c in _ENDS], "has_n boolean", "epoch int"])


def merged_facts(facts):
    """Facts of several deliveries as one row per station."""
    ends = [(F.min if c.endswith("_from") else F.max)(c).alias(c) for c in _ENDS]
    return facts.groupBy("station_id").agg(*ends, F.max("has_n").alias("has_n"), F.max("epoch").alias("epoch"))


def noted_facts(spark, path):
    """Facts of all deliveries, one row per station, or None; after a deletion those of the station before it no longer count."""
    folder = f"{path}-stations"
    if not _exists(spark, folder):
        return None
    notes = spark.read.schema(NOTES).parquet(folder).fillna(0, ["epoch"])
    last = notes.groupBy("station_id").agg(F.max("epoch").alias("_last"))
    return merged_facts(notes.join(last, "station_id").where(F.col("epoch") == F.col("_last")))


def with_epoch(facts, noted, renew=0):
    """Facts under the epoch of what is noted of their station, or a later one that replaces it."""
    facts = facts.withColumn("station_id", F.col("station_id").cast("int"))
    if noted is None:
        return facts.withColumn("epoch", F.lit(renew))
    old = noted.select("station_id", F.col("epoch").alias("_epoch"))
    return facts.join(old, "station_id", "left").withColumn("epoch", F.coalesce("_epoch", F.lit(0)) + renew).drop("_epoch")


def add_facts(facts, path):
    """Note facts that have their epoch."""
    facts.select("station_id", *_ENDS, "has_n", "epoch").write.mode("append").parquet(f"{path}-stations")


def known_from(facts):
    """Per station grid_from and grid_to (span of its first anchor sensor), origin, latest_ts and has_n."""
    first = lambda end, of=ANCHORS: F.coalesce(*[F.col(f"{a}_{end}") for a in of])
    return facts.select(
        "station_id", first("from").alias("grid_from"), first("to").alias("grid_to"),
        first("from", (*ANCHORS, "any")).alias("origin"), first("last", (*ANCHORS, "any")).alias("latest_ts"), "has_n")


def known_stations(spark, path, raw=None):
    """What is known of the stations (see known_from) over all deliveries; a table without notes is read instead."""
    noted = noted_facts(spark, path)
    if noted is None:
        if raw is None:
            return None
        noted = facts_of(raw)
    return known_from(noted)


# --- processed rows ----------------------------------------------------------------------------------

def placed_periods(processed):
    return processed.select(*PROCESSED, F.year("period").alias("year"))


def write_processed(processed, path, from_year=None):
    """Replace the (rule, station_id, year) partitions the rows fall into.

    With ``from_year`` the rows are all there are of their rules from that year on, and partitions without rows go.
    """
    spark, rows = processed.sparkSession, placed_periods(processed)
    step, stored = finish_merge(spark, path, "processed") + 1, read_table(spark, path)
    if stored is None:
        _partitioned_write(rows, path, "overwrite", RULE_PARTS, ORDER["processed"])
        return
    parts = None
    if from_year is not None:
        rows = settled(rows, "processed")
        own = stored.join(rows.select("rule").distinct(), "rule", "left_semi")
        parts = settled(own.where(F.col("year") >= from_year).select(*RULE_PARTS).distinct(), "touched")
    _replace(spark, path, rows, parts, step, "processed")


def replace_periods(spark, fresh, scope, path):
    """Put ``fresh`` rows (settled) in the place of all stored ones with the keys ``scope`` (station_id, rule, anchor).

    The anchor of an hour or a day is its day, that of other rules the period itself, so a key may stand for rows
    that no longer exist.
    """
    step, stored = finish_merge(spark, path, "processed") + 1, read_table(spark, path)
    rows = placed_periods(fresh)
    if stored is None:
        _partitioned_write(rows, path, "overwrite", RULE_PARTS, ORDER["processed"])
        return
    parts = scope.select("rule", "station_id", F.year("anchor").alias("year")).unionByName(rows.select(*RULE_PARTS)).distinct()
    parts = settled(parts, "touched")
    old = _in(stored.withColumn("station_id", F.col("station_id").cast("int")), parts, RULE_PARTS).withColumn("anchor", anchor())
    old = old.join(scope, ["station_id", "rule", "anchor"], "left_anti")
    _replace(spark, path, old.select(rows.columns).unionByName(rows), parts, step, "processed")


def anchor():
    """What a period is touched by: the day of an hour or a day, the period itself of other rules."""
    day = F.to_date("period").cast("timestamp_ntz")
    return F.when(F.col("rule").isin("hourly", "daily"), day).otherwise(F.col("period"))
