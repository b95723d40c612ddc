"""The command line runs the same plans (in-process, reusing the test session)."""

import os
import shutil


from tests.conftest import SAMPLES
from tests.exportfiles import SUBSCRIBERS
from trackyard.__main__ import main


def test_cli_all_then_report(spark, tmp_path):
    exports = str(tmp_path / "exports")
    os.makedirs(exports)
    for f in os.listdir(SAMPLES):
        shutil.copy(os.path.join(SAMPLES, f), exports)
    wh = str(tmp_path / "wh")
    out = main(["all", "--warehouse", wh, "--exports", exports])
    assert out["bronze_status"] == "SUCCESS" and out["silver_status"] == "SUCCESS"
    assert out["gold"]["dim_subscriber"] == SUBSCRIBERS
    rep = main(["report", "--warehouse", wh])
    assert rep["silver_counts"]["total"] == 119
    assert [r["layer"] for r in rep["recent_runs"]] == ["silver", "bronze"]
    again = main(["bronze", "--warehouse", wh, "--exports", exports])
    assert again["files_skipped"] == 3 and again["rows_loaded"] == 0
