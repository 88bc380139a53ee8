"""The library without its optional parts, on a copy that lacks them."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
RUN = """
import __spark_entry__ as contract
from pyspark.sql import SparkSession

assert not [name for name in contract.queries() if name.startswith("op") or name == "pipeline"]
assert contract.oracle_sql().keys() == contract.queries().keys()
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").getOrCreate()
)
assert contract.queries()["row_count"](spark, "/root/testdata/sf0.001").first()[0] > 0
"""


def copy_without(target, *names):
    ignored = shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse", *names)
    shutil.copytree(ROOT, target, ignore=ignored)
    return target


def run(code, folder):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True)


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_without_optional_parts(tmp_path, gone):
    done = run(RUN, copy_without(tmp_path / "copy", *gone))
    assert done.returncode == 0, done.stderr


def test_collection_without_optional_parts(tmp_path):
    folder = copy_without(tmp_path / "copy", "llm", "corpus_pipeline.py")
    done = subprocess.run(
        [sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"],
        cwd=folder, capture_output=True, text=True,
    )
    assert done.returncode == 0, done.stdout + done.stderr


def test_error_inside_a_part_is_not_passed_over(tmp_path):
    folder = copy_without(tmp_path / "copy", "llm")
    (folder / "corpus_pipeline.py").write_text("import no_such_module\n")
    done = run("import __spark_entry__ as contract; contract.queries()", folder)
    assert "no_such_module" in done.stderr and done.returncode != 0
