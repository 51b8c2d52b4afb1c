import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from gradmesh.session import local_session

    s = local_session(4, partitions=8)
    yield s
    s.stop()


def samples_df(spark, rows):
    return spark.createDataFrame(
        [(int(a), [float(v) for v in x], float(y)) for a, x, y in rows],
        "shard_id INT, x ARRAY<DOUBLE>, y DOUBLE",
    )
