"""Command line: list the registered queries and run one to a folder."""

import os
import subprocess
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_cli_list_and_run(spark):
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-m", "fundflow", "list"], env=env, cwd="/tmp",
                         capture_output=True, text=True, timeout=300)
    assert out.returncode == 0 and "fund_long_filtered" in out.stdout.split()
    target = os.path.join(tempfile.mkdtemp(prefix="ff-cli-"), "fw")
    run = subprocess.run([sys.executable, "-m", "fundflow", "run", "fund_wide", "--tables", SF,
                          "--out", target], env=env, cwd="/tmp", capture_output=True, text=True,
                         timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]
    assert "fund_wide:" in run.stdout
    assert spark.read.parquet(target).count() == int(run.stdout.split("fund_wide:")[1].split()[0])
