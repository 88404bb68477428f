import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claim_rows import CLAIM_COLUMNS, THREE_CLAIMS  # noqa: E402
from riskledger.workspace import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture
def three_claims(spark):
    return spark.createDataFrame(THREE_CLAIMS, ", ".join(f"{c} string" for c in CLAIM_COLUMNS))
