import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from zonelens.session import local_session, shared_dir

    s = local_session(cores="4", shuffle_partitions=4, app="zonelens-tests")
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)  # tests run locally: a local checkpoint folder is set when none is named
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
