import datetime
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from weekmart.operators.calendar import build_calendar  # noqa: E402
from weekmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests", "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def calendar(spark):
    """2018 to 2023: 2020 has 53 ISO weeks."""
    return build_calendar(spark, 2018, 2023, 2019, datetime.date(2020, 3, 9)).cache()


@pytest.fixture()
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
    return collect
