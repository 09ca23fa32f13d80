import pytest

from quarrylamp.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "3g", "tests")
    yield s
    s.stop()
