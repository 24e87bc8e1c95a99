"""The registered queries also run where the package is not in the working folder of the workers."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

from tests.conftest import FOLDER

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__
from courtside.session import build_session

spark = build_session("local[2]", 2, **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": {shared!r}}})
queries = __spark_entry__.queries()
print("rows", [queries[name](spark, {folder!r}).count() for name in ("id_density", "high_corr_pairs")])
"""


def test_python_in_tasks_finds_the_package(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    script = SCRIPT.format(root=root, folder=FOLDER, shared=str(tmp_path / "shared"))
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows [1, 2]" in done.stdout, done.stderr[-2000:]
