import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoplens.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def scratch():
    """A fresh scratch folder per test session (tests only: on a cluster the
    jobs use spark.checkpoint.dir)."""
    return tempfile.mkdtemp(prefix="shoplens-test-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    s = get_session(
        master="local[4]",
        shuffle_partitions=8,
        extra={
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            # SHOPLENS_TEST_STATE_STORE=rocksdb runs the streaming tests on the
            # state store the cluster settings use
            "spark.sql.streaming.stateStore.providerClass": (
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
                if os.environ.get("SHOPLENS_TEST_STATE_STORE") == "rocksdb"
                else "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
            ),
        },
    )
    yield s
    s.stop()
