import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from stardw.session import build_session
    s = build_session("local[8]", app="stardw-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("spark-warehouse"))})
    yield s
    s.stop()
