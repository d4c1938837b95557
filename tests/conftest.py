import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sightline.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("sightline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def values(frame, *columns):
    """Rows as a sorted list of tuples."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)


SIGHTING = {
    "record_id": "r",
    "report_date": "2001-12-31",
    "anonymous_id": "c1",
    "sector": "IT",
    "size": "small",
    "data": "1.2.3.4",
    "count_seen": 1.0,
    "first_seen": 1,
    "last_seen": 2,
    "threat_score": 5.0,
    "estimate": "e",
}


def sightings(spark, *rows):
    from sightline.schemas import SIGHTINGS

    full = [{**SIGHTING, **row} for row in rows]
    return spark.createDataFrame([tuple(r[n] for n in SIGHTINGS.fieldNames()) for r in full], SIGHTINGS)
