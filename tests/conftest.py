import pytest

from reelspark.runtime import session

SESSION = session(4, 4)  # made here, as column expressions in test modules need one
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION
