import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from sediment.session import get_session

    scratch = tempfile.mkdtemp(prefix="sediment-tests-")
    s = get_session("sediment-tests", master="local[4]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": scratch,
                           "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_factory_path():
    return tempfile.mkdtemp(prefix="sediment-t-")
