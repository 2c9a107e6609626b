import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyloom.runtime import local_session  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session


@pytest.fixture(scope="session")
def folder():
    return SMALL


def rows(df):
    """Rows as plain tuples, in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
