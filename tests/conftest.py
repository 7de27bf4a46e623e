import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from starmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": "/tmp/starmill-warehouse"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted by all columns so that only the content counts."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))
