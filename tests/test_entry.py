import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).parent.parent


@pytest.mark.parametrize("gone", [("quillstream/llm", "tests/llm"), ("quillstream/llm", "tests/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_entry_without_the_optional_parts(tmp_path, gone):
    for name in ("quillstream", "tests", "__spark_entry__.py", "corpus_pipeline.py"):
        source = REPO / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__"))
        elif source.exists():
            shutil.copy(source, tmp_path / name)
    for name in gone:
        target = tmp_path / name
        if target.is_dir():
            shutil.rmtree(target)
        else:
            target.unlink(missing_ok=True)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'page_scores' in q and set(o) <= set(q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) > 50


def test_the_rest_passes_without_the_optional_parts(tmp_path):
    """Tests of the library run in a copy that has neither the llm folders nor the pipeline."""
    for name in ("quillstream", "tests"):
        shutil.copytree(REPO / name, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", "llm"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    assert not (tmp_path / "quillstream/llm").exists()
    done = subprocess.run([sys.executable, "-m", "pytest", "-q", "-p", "no:cacheprovider", "tests/test_scoring.py", "tests/test_pages.py", "tests/test_trials.py::test_machine_equals_daily_runs_however_days_are_closed"], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stdout[-3000:]
