import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cadenza.session import session

    s = session("local[4]", {"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('ck')}"})
    yield s
    s.stop()
