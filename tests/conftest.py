import pytest

from tests.compare import session


@pytest.fixture(scope="session")
def spark():
    s = session()
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    s.stop()
