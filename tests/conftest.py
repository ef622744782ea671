from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeward.session import local_session  # noqa: E402

# ---------------------------------------------------------------------------
# The two golden order-event batches (test input).
# ---------------------------------------------------------------------------
GOLDEN_HEADER = "event_id,order_id,customer_id,region,status,order_amount,event_ts,ingestion_ts"
GOLDEN_BATCH_1 = [
    "evt-1001,ord-001,cust-001,east,created,120.50,2026-04-20 09:00:00,2026-04-20 09:05:00",
    "evt-1002,ord-001,cust-001,east,delivered,120.50,2026-04-20 14:30:00,2026-04-20 14:32:00",
    "evt-1003,ord-002,cust-002,west,created,89.00,2026-04-20 10:10:00,2026-04-20 10:11:00",
    "evt-1004,ord-003,cust-003,central,created,140.25,2026-04-21 08:00:00,2026-04-21 08:02:00",
    "evt-1005,ord-004,cust-004,east,created,65.75,2026-04-21 12:00:00,2026-04-21 12:01:00",
    "evt-1005,ord-004,cust-004,east,created,65.75,2026-04-21 12:00:00,2026-04-21 12:05:00",
]
GOLDEN_BATCH_2 = [
    "evt-1006,ord-002,cust-002,west,delivered,89.00,2026-04-20 16:45:00,2026-04-22 09:15:00",
    "evt-1007,ord-003,cust-003,central,delivered,140.25,2026-04-21 17:10:00,2026-04-21 17:15:00",
    "evt-1008,ord-004,cust-004,east,cancelled,65.75,2026-04-21 13:10:00,2026-04-21 13:12:00",
    "evt-1009,ord-005,cust-001,east,delivered,210.00,2026-04-22 11:00:00,2026-04-22 11:03:00",
    "evt-1010,ord-006,cust-005,west,delivered,45.00,2026-04-22 18:20:00,2026-04-22 18:21:00",
]


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, memory="4g")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeward-test-ckpt-"))
    yield s


def write_csv(directory, name: str, header: str, rows: list[str]) -> str:
    path = os.path.join(str(directory), name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join([header, *rows]) + "\n")
    return path


@pytest.fixture()
def golden_dir(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_csv(raw, "orders_batch_1.csv", GOLDEN_HEADER, GOLDEN_BATCH_1)
    write_csv(raw, "orders_batch_2.csv", GOLDEN_HEADER, GOLDEN_BATCH_2)
    return raw
