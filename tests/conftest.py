from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparktally.session import get_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[4]", app_name="sparktally-tests", shuffle_partitions=4)
    yield session
    session.stop()


def write_lines(path, lines, newline="\r\n", final_newline=False):
    """Write text lines (CRLF by default, no final newline, as in the
    original inputs)."""
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(newline.join(lines) + (newline if final_newline else ""))
    return str(path)
