import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallyloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = get_session(
        "tests",
        {
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(home / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def schema(spark, tmp_path):
    """A catalog schema of its own for each test."""
    name = f"t_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{tmp_path / 'tables'}'")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


@pytest.fixture
def csv_file(tmp_path):
    """Writes text to a named file and returns its path."""

    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(path)

    return write
