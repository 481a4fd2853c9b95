import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tunemill.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app="tunemill-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tunemill-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tunemill-test-")


def py_token_regex():
    """The token pattern for Python's ``regex`` module (``\\x{H}`` -> ``\\UXXXXXXXX``)."""
    import re

    import regex

    from tunemill.config import TOKEN_PATTERN
    pat = re.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: "\\U%08x" % int(m.group(1), 16), TOKEN_PATTERN)
    return regex.compile(pat)
