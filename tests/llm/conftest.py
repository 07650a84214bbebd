import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    from quire.llm.common import prepare
    return prepare(spark)


@pytest.fixture(scope="session")
def docs(llm):
    return llm.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def sf():
    return SF
