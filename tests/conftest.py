from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import clear_scratch, local_session, path_exists, scratch_root  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, app="tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.shuffle.partitions": "4"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    assert not path_exists(session, scratch_root(session))
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """``frame("a int, b date", rows)``; ISO texts are accepted for dates."""

    def build(schema: str, rows):
        return spark.createDataFrame([tuple(r) for r in rows], schema)

    return build


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *order):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r)) if not order else out
