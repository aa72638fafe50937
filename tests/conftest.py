import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lineflow.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=8, shuffle_partitions=8, app="lineflow-tests")
    yield s
    for q in s.streams.active:
        q.stop()


@pytest.fixture
def text_dir(tmp_path):
    """FIXTURES 5: small text directory with line-end cases and a subfolder."""
    d = tmp_path / "small"
    (d / "sub").mkdir(parents=True)
    (d / "f1.txt").write_bytes(b"a b\nc\n\nd")
    (d / "f2.txt").write_bytes(b"x\r\ny\n")
    (d / "sub" / "f3.txt").write_bytes(b"deep\n")
    return d
