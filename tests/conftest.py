import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tokenmill.session import local_session, prepare
    s = local_session("*", shuffle_partitions=8, app="tokenmill-tests")
    prepare(s)
    yield s


def docs_df(spark, texts):
    """Small corpus: list position is the order key ``doc_id``."""
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
