"""The entry module without the training-data folder."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_works_without_the_llm_folder(tmp_path):
    shutil.copytree(os.path.join(ROOT, "ferrum"), tmp_path / "ferrum", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), any(k.startswith('op') for k in q))"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""}, timeout=120)
    assert got.returncode == 0, got.stderr[-500:]
    assert int(got.stdout.split()[0]) >= 58 and got.stdout.split()[1] == "False"
