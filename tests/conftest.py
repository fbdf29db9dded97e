import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tests.sessions import session

    return session("4")


@pytest.fixture
def folder(spark):
    """A path below the shared folder that does not exist yet."""
    from voxweave.session import work_path

    return work_path(spark, "test")
