import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerlark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        8,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__debug__maxToStringFields="2000",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Result rows as sorted plain tuples; None sorts first."""

    def collected(frame, *columns):
        frame = frame.select(*columns) if columns else frame
        return sorted(
            (tuple(r) for r in frame.collect()),
            key=lambda r: [(v is not None, v) for v in r],
        )

    return collected
