"""Answers do not depend on the zone of the driver process."""

import os
import subprocess
import sys

import pytest

CODE = """
import sys
sys.path[:0] = [{root!r}, {root!r} + "/tests"]
from datetime import datetime, timedelta
from ledgersift.session import build_session
from ledgersift.operators.asof import HIT, asof_join
from ledgersift.workload.queries import QUERIES
from ledgersift.workload.oracle import ORACLE
from compare import assert_same, connect

spark = build_session("zones", "local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.checkpoint.dir": {scratch!r}}})
spark.sparkContext.setLogLevel("ERROR")
rows = spark.sql("select 1L k, timestamp_ntz'2024-01-02 10:00:00' t")
known = spark.sql("select 1L k, timestamp_ntz'2024-01-02 09:00:00' t, 'near' v union all select 1L, timestamp_ntz'2024-01-01 03:30:00', 'far'")
for age in (None, timedelta(hours=25)):
    assert asof_join(rows, known, ["k"], "t", "t", ["v"], max_age=age).first()[HIT].v == "near", age
con = connect("/root/testdata/sf0.001")
for name in ("check_future_dates", "feat_materialize", "feat_online_lookup", "feat_historical", "feat_historical_ttl", "feat_historical_multi", "feat_activity_score"):
    assert_same(QUERIES[name](spark, "/root/testdata/sf0.001"), con, ORACLE[name])
print("all equal")
"""


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_other_zones(zone, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = CODE.format(root=root, scratch=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": zone}, capture_output=True, text=True, timeout=240)
    assert "all equal" in done.stdout, done.stderr[-3000:]
