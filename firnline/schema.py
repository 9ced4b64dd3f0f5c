"""Column types, fixed tables and physical constants shared by all operators."""

from pyspark.sql import types as T

# --- fixed values: sensor codes of the weather portal ---------------------
# LT air temperature, LF humidity, HS snow height, N precipitation,
# SD sunshine duration, GS global radiation
SENSORS = ("LT", "LF", "HS", "N", "SD", "GS")
SENSOR_COLS = tuple(s.lower() for s in SENSORS)

# --- fixed values: weather stations (id, name, portal code) ---------------
STATIONS = (
    (1, "Piz La Ila", "61690SF"),
    (2, "Rossalm", "42830SF"),
    (3, "Piz Pisciadu", "61720WS"),
    (4, "Wolkenstein", "73500MS"),
    (5, "St. Martin", "62600MS"),
    (6, "St. Veit", "42700MS"),
)
STATION_ID = {name: sid for sid, name, _ in STATIONS}

# --- fixed values: the two lakes ------------------------------------------
# catchment in m2; rating polynomials in water depth (m), highest power first
LAKES = {
    "Limo": {
        "catchment_m2": 849285.0,
        "area": (41.05090849623958, -876.9004337585678, 7252.335363659846, -9634.640993941795),
        "volume": (931.46, -739.07, 698.83),
        "sentinel_wd": 11.0,
    },
    "Parom": {
        "catchment_m2": 8039068.0,
        "area": (3049.762182195784, -3382.009706965325),
        "volume": (1372.99, -2808.53, 1728.66),
        "sentinel_wd": None,
    },
}

# --- fixed values: model coefficients -------------------------------------
SWE_ACCUMULATION = (0.0533, 0.948, 0.1701, -0.1314, 0.2922)
SWE_ABLATION = (0.0481, 1.0395, 0.1699, -0.0461, 0.1804)
LATITUDE_DEG = 46.6792
EVAPOTRANSPIRATION_SHARE = 0.12
GROUNDWATER_OUTFLOW_LS = 9.1
PORTAL_START = "2014-08-01"
REQUEST_DAYS = 835
REQUEST_DAYS_PRECIPITATION = 418
GOOD_STATUS = "40 (Gut)"
MISSING_MARK = "---"

# --- fixed values: aliases of the resampling rules ------------------------
RULES = {
    "hourly": ("Hourly", "h"),
    "daily": ("Daily", "d"),
    "weekly": ("Weekly", "w"),
    "monthly": ("Monthly", "m"),
    "movavg": ("movAVG", "Moving", "mAVG"),
}
PERIOD_RULES = ("hourly", "daily", "weekly", "monthly")

READINGS = T.StructType([
    T.StructField("station_id", T.IntegerType()),
    T.StructField("sensor", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()),
])
RAW_WIDE = T.StructType(
    [T.StructField("station_id", T.IntegerType()), T.StructField("ts", T.TimestampNTZType())]
    + [T.StructField(c, T.DoubleType()) for c in SENSOR_COLS]
)
PORTAL_JSON = "DATE string, VALUE double"


def rule_name(alias):
    """Canonical rule for any of its spellings; unknown spellings are an error."""
    for name, spellings in RULES.items():
        if alias == name or alias in spellings:
            return name
    raise ValueError(f"unknown rule {alias!r}; use one of {sorted(RULES)}")


def sensor_list(sensors):
    """Column names for a comma list or sequence of sensor codes, checked against SENSORS."""
    parts = sensors.split(",") if isinstance(sensors, str) else list(sensors)
    cols = [p.strip().lower() for p in parts if p.strip()]
    unknown = [c for c in cols if c not in SENSOR_COLS]
    if unknown:
        raise ValueError(f"unknown sensors {unknown}; use some of {SENSORS}")
    return cols


def values_table(spark, names, rows):
    """A DataFrame of fixed rows as a local relation, whose size the optimizer knows."""
    def lit(v):
        if v is None:
            return "null"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        if isinstance(v, float):
            return f"{v!r}D"
        if isinstance(v, (tuple, list)):
            return "array(" + ", ".join(lit(x) for x in v) + ")"
        return str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")
