from __future__ import annotations

import os

import pytest

from fathomline.session import local_session
from fathomline.sources.tables import Tables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "8", 8)


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
