import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    yield session
    session.stop()


def day(text: str | None) -> dt.date | None:
    return None if text is None else dt.date.fromisoformat(text)


def collected(df, *columns):
    """Rows as a sorted list of tuples, NULLs first."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
