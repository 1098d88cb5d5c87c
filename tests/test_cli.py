"""Command line: compact a log tree, then run the usage job on the compacted table."""

from __future__ import annotations

import glob
import json
import os
import subprocess
import sys
import tempfile

from .conftest import write_tree

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    out = subprocess.run([sys.executable, "-m", "logtide", "--master", "local[2]", *args],
                         cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_compact_then_usage_job():
    base = tempfile.mkdtemp(prefix="logtide-cli-")
    logs = write_tree(os.path.join(base, "logs"))
    table = os.path.join(base, "table")
    res = _run("compact", table, f"{logs}/application_*", f"{logs}/nested")
    assert res["roots"] == 2
    out = _run("usage", "--compacted", table, os.path.join(base, "out"))
    (part,) = glob.glob(os.path.join(out["usage_stats"], "part-*"))
    with open(part) as f:
        assert f.read().startswith("Total clusters: 2\nTotal applications: 3\n")
