"""The library works without the training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("pipeline", [True, False])
def test_import_without_the_subpackage(tmp_path, pipeline):
    shutil.copytree(ROOT / "quartermaster", tmp_path / "quartermaster", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *["corpus_pipeline.py"] * (pipeline and (ROOT / "corpus_pipeline.py").exists())]:
        shutil.copy(ROOT / name, tmp_path)
    code = ("import __spark_entry__ as e; q = e.queries(); assert len(q) >= 79 and 'pipeline' not in q, len(q); "
            "assert not any(n.startswith('op') and n[2].isdigit() for n in q); e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
