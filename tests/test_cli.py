"""The command line over a folder of raw CSV files (own Spark process)."""

import json
import os
import subprocess
import sys
import tempfile

from tests.test_streaming import day_rows, write_csv
from tests.test_validate import ok

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_runs_all_stages_on_raw_csv():
    base = tempfile.mkdtemp(prefix="adlens-cli-")
    src = os.path.join(base, "incoming")
    os.makedirs(src)
    rows = day_rows("a", ["17/08/2017", "18/08/2017", "19/08/2017", "20/08/2017"])
    rows += [ok(ad_id="x", campaign_id="45-49"), ok(ad_id="a0", spent="-1")]
    write_csv(os.path.join(src, "part1.csv"), rows)
    out = subprocess.run(
        [sys.executable, "-m", "adlens", "--raw", src, "--warehouse",
         os.path.join(base, "wh"), "--master", "local[2]"],
        cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    rep = json.loads(out.stdout.strip().splitlines()[-1])
    v = rep["validation"]
    assert (v["total_rows"], v["reason_invalid_campaign"], v["reason_negative_spend"]) == (6, 1, 1)
    assert rep["load"]["inserted"] == 5  # rule 1 only, as the reference loads
    assert os.path.isdir(os.path.join(base, "wh", "anomaly_log"))
