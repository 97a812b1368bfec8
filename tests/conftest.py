import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from interlens.session import local_session
    s = local_session("4", shuffle_partitions=4, app="interlens-tests")
    yield s
    from interlens.session import release_scratch
    release_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def interactions(spark):
    from interlens.sources import views
    return views.stored_interactions(spark, SF001)
