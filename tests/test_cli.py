"""The command line runs the build and prints a metric."""

import os

from orderflow.__main__ import main
from orderflow.plans import models
from tests.conftest import SF_SMALL


def test_build_then_metric(spark, tmp_dir, capsys):
    proc = os.path.join(tmp_dir, "processed")
    models.processed_events(spark, SF_SMALL).write.parquet(proc)
    root = os.path.join(tmp_dir, "wh")
    assert main(["build", "--processed", proc, "--root", root]) == 1          # duplicate keys block it
    assert main(["build", "--processed", proc, "--root", root, "--allow-duplicate-keys"]) == 0
    assert main(["metric", "orders_by_status", "--root", root]) == 0
    out = capsys.readouterr().out
    assert "published" in out and "pending" in out and "444" in out
