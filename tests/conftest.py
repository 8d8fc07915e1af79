import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sylva.session import get_session
    s = get_session(cores=4, shuffle_partitions=8, app="sylva-tests", checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    yield s
    s.stop()
