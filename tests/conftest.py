from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = TESTDATA / "sf0.001"
    if not path.exists():
        pytest.skip("no test tables")
    return str(path)


def at(text: str) -> datetime:
    """'01 10:00:00.5' -> that moment in January 2024."""
    day, _, clock = text.partition(" ")
    return datetime.fromisoformat(f"2024-01-{day} {clock or '00:00:00'}")


FACT = (
    "event_id bigint, event_ts timestamp_ntz, user_id bigint, session_id string, event_type string, "
    "product_id bigint, category_id bigint, category_code string, brand string, price double"
)
FACT_DEFAULTS = {
    "user_id": 1,
    "session_id": "s",
    "event_type": "view",
    "product_id": 10,
    "category_id": 100,
    "category_code": "c",
    "brand": "b",
    "price": 5.0,
}


def make_events(spark, *rows):
    """Event rows from dicts; ``ts`` is a short time, everything else has a default."""
    from pyspark.sql import functions as F

    names = [part.split()[0] for part in FACT.split(", ")]
    data = []
    for number, row in enumerate(rows):
        full = {**FACT_DEFAULTS, "event_id": number, **row}
        full["event_ts"] = at(full.pop("ts"))
        data.append(tuple(full[name] for name in names))
    frame = spark.createDataFrame(data, FACT)
    return frame.withColumn("event_date", F.to_date("event_ts"))


def rows_of(df):
    return [row.asDict(recursive=True) for row in df.collect()]


def only(df):
    rows = rows_of(df)
    assert len(rows) == 1
    return rows[0]
