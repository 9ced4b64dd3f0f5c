import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows('station_id int, ts timestamp_ntz', [...]) -> DataFrame, times given as text."""
    def make(schema, data):
        names = [part.split()[0] for part in schema.split(",")]
        types = [part.split()[1] for part in schema.split(",")]
        loose = ", ".join(f"{n} {'string' if t in ('timestamp_ntz', 'date') else t}" for n, t in zip(names, types))
        df = spark.createDataFrame(data, loose)
        return df.selectExpr(*[f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types)])

    return make


@pytest.fixture
def listed():
    """Rows as tuples, sorted by the given columns."""
    def make(df, *order):
        return [tuple(r) for r in df.orderBy(*order).collect()]

    return make
