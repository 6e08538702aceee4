"""The rest works where the training-data operators are taken out."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]


@pytest.mark.parametrize("caches", [False, True])
@pytest.mark.parametrize("left", [(), ("corpus_pipeline.py",)])
def test_entry_imports_without_the_subpackage(tmp_path, left, caches):
    for p in ("__spark_entry__.py", "fernlight", *left):
        os.symlink(ROOT / p, tmp_path / p) if p.endswith(".py") else _copy_without(ROOT / p, tmp_path / p)
    if caches:  # what a run leaves behind when the files are removed
        (tmp_path / "fernlight/llm/__pycache__").mkdir(parents=True)
        (tmp_path / "fernlight/llm/__pycache__/queries.cpython-313.pyc").write_bytes(b"")
    code = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip().endswith("[]") and int(out.stdout.split()[0]) > 30


def _copy_without(source, to):
    import shutil

    shutil.copytree(source, to, ignore=shutil.ignore_patterns("llm", "__pycache__"))


@pytest.mark.parametrize("path", [p for p in (ROOT / "fernlight").rglob("*.py") if "llm" not in p.parts])
def test_nothing_else_imports_it(path):
    assert "fernlight.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text()
