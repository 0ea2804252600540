import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_rows_of_failed_attempts_are_not_counted(tmp_path):
    done = subprocess.run(
        [sys.executable, "-m", "tests.retry_job", str(tmp_path)],
        cwd=ROOT,
        env={**os.environ, "PYTHONPATH": ROOT},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert "RESULT SUCCESS 100000 100000 100000" in done.stdout, done.stdout + done.stderr
