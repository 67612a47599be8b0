import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemart.session import build_session

    s = build_session(
        "local[4]",
        "tidemart-tests",
        shuffle_partitions=8,
        extra_conf={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))},
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def graph_small(spark):
    from helpers import SF_SMALL
    from tidemart.plans.graph import ModelGraph

    return ModelGraph.from_testdata(spark, SF_SMALL)
