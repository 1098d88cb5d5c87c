"""Failed task attempts are retried with identical results (deterministic operators)."""

from __future__ import annotations

import os
import subprocess
import sys


def test_results_survive_a_failed_task_attempt():
    here = os.path.dirname(os.path.abspath(__file__))
    out = subprocess.run([sys.executable, os.path.join(here, "retry_check.py")],
                         capture_output=True, text=True, timeout=600)
    assert "retry-ok" in out.stdout, out.stderr[-2000:]
