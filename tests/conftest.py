import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from inkwell.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="inkwell-tests")
    yield s


@pytest.fixture
def docs_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id bigint, text string")
    return make
