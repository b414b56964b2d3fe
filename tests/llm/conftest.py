"""Fixtures of the operators for training data."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from llm_rows import SCHEMA, TEXTS  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeats, and columns whose names operators also use."""
    rows = [(i, t, "en" if k % 2 else None, "s", None if t is None else len(t), 1.5, "x") for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
