import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers_llm import edge_docs, empty_docs  # noqa: E402


@pytest.fixture
def edge(spark):
    return edge_docs(spark)


@pytest.fixture
def empty(spark):
    return empty_docs(spark)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
