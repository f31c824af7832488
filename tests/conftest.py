import datetime as dt

import pytest

from tidecast.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session("tests", 4, **{"spark.checkpoint.dir": folder, "spark.driver.memory": "6g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_series(spark):
    """Canonical series from {name: values}, one value per day from a start day."""
    def make(start=dt.date(2024, 1, 1), **series):
        rows = [(name, start + dt.timedelta(days=i), float(v))
                for name, values in series.items() for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "series string, date date, value double")
    return make
