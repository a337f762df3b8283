import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import workload
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["analysis", "x_variable", "y_variable", "pearson_r", "p_value", "n"]


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_subpackage(tmp_path, pipeline):
    """The rest imports and keeps its queries where the subpackage, or the pipeline over it too, is gone."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    gone = ["llm", "__pycache__", ".git", *([] if pipeline else ["corpus_pipeline.py"])]
    shutil.copytree(root, tmp_path / "copy", ignore=shutil.ignore_patterns(*gone))
    code = "import __spark_entry__ as e; print(len(e.queries()), *[q for q in e.queries() if q.startswith('op') or q == 'pipeline'])"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(workload.QUERIES))], out.stderr
