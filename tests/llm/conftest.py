from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import SCHEMA, rows  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
