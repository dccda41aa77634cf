"""One local session and small review and product tables for all tests."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from starmill.session import build_session  # noqa: E402

CLEAN_REVIEWS = (
    "reviewerID string, asin string, unix_time bigint, rating double, verified boolean, "
    "helpful_votes int, review_length int, review_year int, summary string, reviewText string"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.session.timeZone": "America/New_York",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.001")
    if not Path(path).is_dir():
        pytest.skip(f"no test tables in {path}")
    return path


def review(user="u", item="i", time=1, rating=5.0, verified=True, votes=0, length=10,
           year=2012, summary="", body=""):
    return (user, item, time, rating, verified, votes, length, year, summary, body)


@pytest.fixture
def reviews_of(spark):
    return lambda *rows: spark.createDataFrame(list(rows), CLEAN_REVIEWS)


@pytest.fixture
def products_of(spark):
    return lambda *rows: spark.createDataFrame(
        list(rows), "asin string, price double, brand string"
    )


def rows(df):
    """Collected rows as plain tuples."""
    return [tuple(row) for row in df.collect()]


def plan(df):
    """The final physical plan as text, after the query has run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("\n+- == Initial Plan ==")[0]
