"""Task failures and retries do not change any warehouse table (keys are
deterministic or checkpointed; no result depends on attempt order)."""

import os
import subprocess
import sys

from paths import SF_SMALL


def test_retried_tasks_give_identical_tables():
    here = os.path.dirname(os.path.abspath(__file__))
    out = subprocess.run([sys.executable, os.path.join(here, "fault_injection_run.py"), SF_SMALL],
                         capture_output=True, text=True, timeout=900)
    lines = [l for l in out.stdout.splitlines() if l.startswith("RESULT")]
    assert lines, out.stderr[-3000:]
    assert lines[0].split()[1] == "identical", lines[0]
    assert int(lines[0].split()[2]) > 0
