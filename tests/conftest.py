import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pedalgrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(master=f"local[{os.environ.get('TEST_CPUS', '4')}]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture()
def rows():
    """Collected rows as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))

    return collect
