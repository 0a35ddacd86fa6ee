import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [p for p in (ROOT, os.path.join(ROOT, "tests")) if p not in sys.path]

from monthgrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, memory="8g", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def monthly(spark):
    """``make({series: [values]}, start)`` as (series, period, value); None is NULL, "gap" has no row."""
    import pandas as pd

    def make(series, start="2018-01-01"):
        rows = []
        for name, values in series.items():
            months = pd.date_range(start, periods=len(values), freq="MS")
            rows += [(name, m.date(), None if v is None else float(v)) for m, v in zip(months, values) if v != "gap"]
        return spark.createDataFrame(rows, "series string, period date, value double")

    return make


def by_period(df, *cols):
    """{period: row values} of the collected frame."""
    return {r["period"]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}
