import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sonde.session import session

    s = session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="6g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
