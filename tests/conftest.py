import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyspark.session import local_session  # noqa: E402
from workbench.lake import drop_lakes  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_lakes(session)
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Build a DataFrame from a schema and rows; dates are ISO text."""

    def build(schema: str, rows: list[tuple]):
        names = [part.split() for part in schema.split(",")]
        loose = ", ".join(f"{n} {'string' if t in ('date', 'timestamp') else t}" for n, t in names)
        df = spark.createDataFrame(rows, loose)
        return df.select(*[df[n].cast(t).alias(n) for n, t in names])

    return build
