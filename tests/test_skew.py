"""Hot-key behaviour measured from task metrics (event log) in a separate Spark process."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_CHECK


def test_hot_key_is_spread_over_tasks():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tests", "skew_report.py"), SF_CHECK, "--json"],
                         cwd=ROOT, capture_output=True, text=True, timeout=900)
    r = json.loads(out.stdout.strip().splitlines()[-1])
    share = {k: v[0] for k, v in r.items()}
    # a third of all rows share one key; 16 tasks, so the ideal share is 6.25 %
    assert share["lead_within_key (slices)"] < 0.15
    assert share["interval_faults (slices)"] < 0.15
    assert share["dense_surrogate_key (range buckets)"] < 0.15
    assert share["dedup_latest (aggregate, partial)"] < 0.15
    assert share["left join on hot key (AQE skew split)"] < 0.15
    # the plain forms put the hot key (or everything) in one task
    assert share["plain: lead() over partition by key"] > 0.3
    assert share["plain: row_number() over (order by)"] > 0.99
