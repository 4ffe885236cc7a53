import pickle
import subprocess
import sys
from pathlib import Path


def test_failed_task_is_repeated_without_harm(small, tmp_path):
    """Puts are keyed, so what the failed attempt wrote is written again, not twice."""
    store = tmp_path / "store"
    store.mkdir()
    script = Path(__file__).with_name("retried_load.py")
    result = subprocess.run(
        [sys.executable, str(script), small, str(store)],
        capture_output=True, text=True, timeout=180, check=True,
    )
    written, expected = map(int, result.stdout.split())
    assert (tmp_path / "failed").exists()
    puts = [put for path in store.iterdir() for put in pickle.loads(path.read_bytes())]
    assert len(puts) > expected  # one batch was put by both attempts
    assert written == len(dict(puts)) == expected
