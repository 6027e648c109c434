from __future__ import annotations

import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hourloom.schemas import SERIES  # noqa: E402
from hourloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = str(tmp_path_factory.mktemp("work"))
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=work,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def hours(start: str, n: int, step: timedelta = timedelta(hours=1)) -> list[datetime]:
    return [at(start) + k * step for k in range(n)]


@pytest.fixture
def series(spark):
    """A series frame from (ts, d) pairs or from {series_id: pairs}."""

    def make(rows):
        if not isinstance(rows, dict):
            rows = {"a": rows}
        flat = [(sid, ts, None if d is None else float(d)) for sid, pairs in rows.items() for ts, d in pairs]
        return spark.createDataFrame(flat, SERIES)

    return make


def collected(df, *columns):
    columns = columns or df.columns
    return ordered(tuple(r[c] for c in columns) for r in df.collect())


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, v) for v in row))
