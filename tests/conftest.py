from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from line_rows import LINE, at  # noqa: E402
from pulseline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lines(spark):
    """Lines that arrive one second apart, or at given seconds."""

    def make(values, seconds=None):
        seconds = seconds or range(len(values))
        return spark.createDataFrame([(v, i, at(s)) for i, (v, s) in enumerate(zip(values, seconds))], LINE)

    return make
