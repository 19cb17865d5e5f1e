from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from deskmill.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_driver_memory="6g",
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SF_SMALL


RAW_DEFAULTS = {
    ":updated_at": "2025-01-02T00:00:00.000Z",
    "unique_key": "1",
    "created_date": "2025-01-01T00:00:00.000",
    "agency": "NYPD",
    "complaint_type": "Noise",
    "status": "Open",
    "borough": "queens",
    "latitude": "40.7",
    "longitude": "-73.9",
}


@pytest.fixture
def raw(spark):
    """Build raw tickets from dicts; missing fields take a valid default."""
    from deskmill.schema import RAW_FIELDS, RAW_SCHEMA

    def build(*rows):
        full = [{**RAW_DEFAULTS, **row} for row in rows]
        return spark.createDataFrame([[r.get(f) for f in RAW_FIELDS] for r in full], RAW_SCHEMA)

    return build


@pytest.fixture
def tickets(raw):
    from deskmill.operators.normalize import enrich, normalize

    def build(*rows):
        return enrich(normalize(raw(*rows)))

    return build
