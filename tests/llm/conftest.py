import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent)]


@pytest.fixture(scope="session")
def odd(spark):
    from llm_cases import odd_documents

    return odd_documents(spark)


@pytest.fixture(scope="session")
def empty(spark):
    from llm_cases import SCHEMA

    return spark.createDataFrame([], SCHEMA)
