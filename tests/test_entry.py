"""The entry points of a copy without the training-data folders."""

import shutil
import subprocess
import sys

from conftest import ROOT

SCRIPT = """
import __spark_entry__ as entry
from worktide.catalog import all_oracles, all_queries
assert entry.queries().keys() == all_queries().keys()
assert entry.oracle_sql().keys() == all_oracles().keys()
print(len(entry.queries()))
"""


def test_entry_without_training_data_folders(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(ROOT / name, tmp_path / name)
    shutil.copytree(ROOT / "worktide", tmp_path / "worktide", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin"})
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) > 150
