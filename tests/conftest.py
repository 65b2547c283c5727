from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tripspark.session import build_session

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session(master="local[4]", shuffle_partitions=8,
                      conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g",
                            # tiny tables: keep 8 writer tasks instead of coalescing to one
                            "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
