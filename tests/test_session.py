"""The shared folder; results that must not depend on the host's time zone."""

from __future__ import annotations

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

from editlume import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"
PROBE = """
from editlume.plans import reference as r
from editlume.session import build_session
s = build_session("local[2]", **{"spark.sql.shuffle.partitions": "2"})
for name in ("month_edits", "rev_month", "month_fa", "new_editors_weekly", "articles_till_month"):
    print("ROWS", name, sorted(map(str, r.QUERIES[name](s, "/root/testdata/sf0.001").collect())))
"""


def stub(master, **conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k.split(".")[1], d)), sparkContext=SimpleNamespace(master=master, applicationId="test"))


def test_shared_folder():
    assert session.scratch_root(stub("yarn", checkpoint="hdfs:///x/")) == "hdfs:///x"
    assert session.scratch_root(stub("local[2]")) == session.scratch_root(stub("local")) and session.scratch_root(stub("local[*]")).startswith("file:")
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(ValueError):
            session.scratch_root(stub(master))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_results_in_any_time_zone():
    seen = set()
    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        out = subprocess.run([sys.executable, "-c", PROBE], cwd=ROOT, env={**os.environ, "TZ": zone}, capture_output=True, text=True, timeout=300)
        lines = [x for x in out.stdout.splitlines() if x.startswith("ROWS")]
        assert len(lines) == 5, out.stderr[-2000:]
        seen.add("\n".join(lines))
    assert len(seen) == 1
