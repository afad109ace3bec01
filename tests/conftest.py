import pytest

from quern.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(cores=4, partitions=4, memory="4g", shared=f"file://{tmp_path_factory.mktemp('shared')}")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
