import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture()
def rows():
    def collect(df, *keys):
        out = [r.asDict(recursive=True) for r in df.collect()]
        return sorted(out, key=lambda r: [str(r[k]) for k in keys]) if keys else out

    return collect
