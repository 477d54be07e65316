"""Injected task failures (retried) leave the skew-safe running total exact."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_running_sum_survives_task_failures():
    script = os.path.join(ROOT, "tests", "fault_script.py")
    res = subprocess.run([sys.executable, script, ROOT], capture_output=True, text=True, timeout=600)
    lines = [l for l in res.stdout.splitlines() if l.startswith("DIFF")]
    assert lines, res.stderr[-2000:]
    _, diff, n = lines[-1].split()
    assert diff == "0" and n == "20000"
