"""Lake logs, isotope samples, logger sheets and station tables."""

from pyspark.sql import functions as F

from ..schema import STATIONS, values_table

# --- fixed values: column names of the input files -------------------------
LAKE_LOG = {
    "Limo": "Datum date, WD double, Vol double, W_change double",
    "Parom": "Datum date, Volume double, WD double, W_change double",
}
LAKE_CALC = (
    "Datum date, Area double, Area_glatt double, Vol_calc double, Volume double, "
    "WD double, WD_calc double, WD_calc_smooth double"
)
ISOTOPES = "Datum date, Sample string, d18O double, `s.d. d18O` double, d2H double, `s.d. d2H` double, Quelle string"
LOGGER_NAMES = {
    "Date Time, GMT+02:00": "ts",
    "Temp, °C": "wt",
    "T2 (m)": "wd",
    "Specific Conductance, μS/cm": "slt",
}
METADATA_JSON = "map<string, struct<coords: array<double>, scode: string, alt: int>>"


def _csv(spark, path, schema):
    return spark.read.csv(path, header=True, schema=schema)


def read_lake_log(spark, path, lake):
    """Daily depth, volume and volume change of one lake under common names."""
    df = _csv(spark, path, LAKE_LOG[lake]).withColumnsRenamed({"Datum": "date", "WD": "wd", "Vol": "volume", "Volume": "volume", "W_change": "w_change"})
    return df.select(F.lit(lake).alias("lake"), "date", "wd", "volume", "w_change")


def read_lake_calc(spark, path, lake):
    """Sparse measured and calculated areas, volumes and depths of one lake."""
    df = _csv(spark, path, LAKE_CALC)
    df = df.toDF(*["date" if c == "Datum" else c.lower() for c in df.columns])
    return df.select(F.lit(lake).alias("lake"), "*")


def read_isotopes(spark, path):
    return _csv(spark, path, ISOTOPES).toDF("date", "sample", "d18o", "d18o_sd", "d2h", "d2h_sd", "site")


def station_metadata(documents, column="value"):
    """JSON documents {name: {coords, scode, alt}} -> one row per station."""
    return (
        documents.select(F.explode(F.from_json(column, METADATA_JSON)).alias("name", "m"))
        .select(
            "name", F.col("m.scode").alias("scode"), F.col("m.alt").alias("alt"),
            F.get("m.coords", F.lit(0)).alias("x"), F.get("m.coords", F.lit(1)).alias("y"),
        )
    )


def read_station_metadata(spark, path):
    """Metadata files, each read whole: they hold one document of a few stations."""
    return station_metadata(spark.read.text(path, wholetext=True))


def stations(spark):
    return values_table(spark, ["station_id", "station_name", "station_code"], STATIONS)


def normalise_logger(df, keep, names=LOGGER_NAMES):
    """Keep columns by position and give them their short names; unknown names are an error."""
    chosen = [df.columns[i] for i in keep]
    unknown = [c for c in chosen if c not in names and c not in names.values()]
    if unknown:
        raise ValueError(f"no short name for {unknown}")
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in chosen])


def read_logger(spark, path, schema, keep, names=LOGGER_NAMES):
    """Logger sheet exported as CSV."""
    return normalise_logger(_csv(spark, path, schema), keep, names)

