import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sensorlab.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", memory="8g")


@pytest.fixture
def series(spark):
    """Build a one-series table from (minute offset, temperature[, humidity]) rows."""
    def build(rows, device=1, zone="Zone 1", house="House 1"):
        number = lambda v: None if v is None else float(v)
        full = [(zone, device, house, float(r[0]), number(r[1]), number(r[2]) if len(r) > 2 else None) for r in rows]
        df = spark.createDataFrame(full, "zone string, device_id bigint, house string, m double, temperature double, humidity double")
        return df.selectExpr(
            "zone", "device_id", "house",
            "CAST(timestamp_micros(CAST(1704067200000000 + m * 60000000 AS BIGINT)) AS TIMESTAMP_NTZ) AS time", "temperature", "humidity")
    return build


@pytest.fixture
def values():
    """Temperatures (or another column) in time order."""
    def collect(df, column="temperature"):
        return [r[column] for r in df.orderBy("time", column).collect()]
    return collect
