from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketprep.session import get_session
    s = get_session("local[4]", app="marketprep-tests", shuffle_partitions=8)
    yield s
    s.stop()


def plan_text(df, mode: str = "formatted") -> str:
    """What ``df.explain(mode=...)`` prints, as a string (public API only)."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def write_text(path: str, text: str, newline: str = "\n") -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text.replace("\n", newline))
