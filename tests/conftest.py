import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from chainlake import get_session, scratch_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A new shared folder name."""
    return lambda label="test": scratch_dir(spark, label)


@pytest.fixture
def rows():
    """Collect a DataFrame as sorted plain tuples."""

    def collect(df, *names):
        df = df.select(*names) if names else df
        plain = (
            tuple(bytes(v) if isinstance(v, bytearray) else v for v in row)
            for row in df.collect()
        )
        return sorted(plain, key=lambda row: tuple((v is None, v) for v in row))

    return collect
