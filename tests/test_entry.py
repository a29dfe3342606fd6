"""The entry file without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("more", [(), ("corpus_pipeline.py",)])
def test_entry_without_the_llm_folders(tmp_path, more):
    """The queries of the rest stand; nothing of the operators is left, whether the pipeline's file is there or not."""
    target = tmp_path / "repo"
    shutil.copytree(ROOT, target, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", *more))
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), sorted(set(s) - set(q)), " \
           "[n for n in q if n.startswith('op') or n == 'pipeline'])"
    found = subprocess.run([sys.executable, "-c", code], cwd=target, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr[-2000:]
    number, rest = found.stdout.strip().splitlines()[-1].split(" ", 1)
    assert int(number) > 180 and rest == "[] []"


def test_nothing_outside_imports_the_subpackage():
    for file in (ROOT / "tallyworks").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT / "tallyworks").parts:
            text = file.read_text()
            assert "tallyworks.llm" not in text and "from tallyworks import llm" not in text, file
