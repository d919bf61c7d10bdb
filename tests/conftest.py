import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import gleanwork
from gleanwork.session import local_session
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(gleanwork)


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")
