import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from topicweave.session import local_session

    s = local_session(
        master="local[*]",
        shuffle_partitions=8,
        input_partitions=8,
        checkpoint_dir=tempfile.mkdtemp(prefix="tw-test-ckpt-", dir="/tmp"),
    )
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tw-test-", dir="/tmp")
