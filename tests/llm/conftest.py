import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from morbidity.llm.common import importable  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    importable(spark)


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")

