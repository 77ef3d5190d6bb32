import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bookpipe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(4, shuffle_partitions=4, **{"spark.sql.warehouse.dir": str(warehouse)})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not here")
    return folder
