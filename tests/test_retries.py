"""Failed task attempts are retried with the same result: draws are pure
functions of (seed, step, id) and every kernel is deterministic."""

import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def run(mode: str) -> dict:
    out = subprocess.run([sys.executable, os.path.join(HERE, "retry_script.py"), mode],
                         capture_output=True, text=True, timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_injected_task_failures_do_not_change_results():
    clean = run("clean")
    flaky = run("inject")
    assert flaky == clean
