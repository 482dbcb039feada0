from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tallyflow.session import build_session

    scratch = tempfile.mkdtemp(prefix="tallyflow-test-")
    # The catalog's default folder (bucketed tables register there) stays
    # out of the working tree. The checkpoint folder is the one the
    # environment names; only when none is named does the library create
    # its own (tallyflow.session.shared_path).
    extra = {"spark.sql.warehouse.dir": f"{scratch}/warehouse"}
    partitions = int(os.environ.get("TEST_SHUFFLE_PARTITIONS", "8"))
    s = build_session(master="local[*]", shuffle_partitions=partitions, extra=extra)
    yield s
    s.stop()
