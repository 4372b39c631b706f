"""The entry points without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
FOLDER = "/root/testdata/sf0.001"

SCRIPT = """
import __spark_entry__ as entry
names = set(entry.queries())
assert "pipeline" not in names and not [n for n in names if n.startswith("op")], names
assert set(entry.oracle_sql()) <= names and len(names) >= 73, len(names)
from gustledger.session import local_session
assert entry.queries()["count_by_key"](local_session(2, "1g"), "{folder}").count() > 0
"""


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
@pytest.mark.parametrize("without", [("gustledger/llm",), ("gustledger/llm", "corpus_pipeline.py")])
def test_imports_and_runs_without_the_training_data_operators(tmp_path, without):
    skip = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache")
    shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda d, names: {*skip(d, names), *[n for n in names if str((Path(d) / n).relative_to(ROOT)) in without]})
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(folder=FOLDER)], cwd=tmp_path / "copy", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
