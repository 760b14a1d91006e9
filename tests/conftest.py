import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gleaner.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", shuffle_partitions=4, app="tests")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
