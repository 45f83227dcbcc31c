"""The entry works without the training-data operators and the pipeline."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_imports_without_the_optional_part(tmp_path):
    shutil.copytree(f"{ROOT}/staymill", tmp_path / "staymill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py"):
        shutil.copy(f"{ROOT}/{name}", tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 150 and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    for extra in ([], ["corpus_pipeline.py"]):  # also with the pipeline still there
        for name in extra:
            shutil.copy(f"{ROOT}/{name}", tmp_path / name)
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
