"""The entry file without the corpus operators, and without the libraries they need."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from stayflow.queries import QUERIES, SQL

ROOT = Path(__file__).resolve().parents[1]
LISTED = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def copy_to(folder, *left_out):
    for name in ("stayflow", "__spark_entry__.py", "corpus_pipeline.py"):
        if name in left_out:
            continue
        if (ROOT / name).is_dir():
            shutil.copytree(ROOT / name, folder / name, ignore=shutil.ignore_patterns("__pycache__", *left_out))
        elif (ROOT / name).exists():
            shutil.copy(ROOT / name, folder / name)


def listed(folder, before=""):
    run = subprocess.run(
        [sys.executable, "-B", "-c", before + LISTED], cwd=folder, capture_output=True, text=True, timeout=300, check=True
    )
    return json.loads(run.stdout.strip().splitlines()[-1])


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_without_folders(tmp_path, left_out):
    copy_to(tmp_path, *left_out)
    names, with_sql = listed(tmp_path)
    assert set(QUERIES) <= set(names) and set(SQL) <= set(with_sql) and "pipeline" not in names
    if "llm" in left_out:
        assert names == sorted(QUERIES)


def test_without_a_library(tmp_path):
    copy_to(tmp_path)
    names, _ = listed(tmp_path, "import sys; sys.modules['sentencepiece'] = None; sys.modules['public_tokenizers'] = None; ")
    assert names == sorted(QUERIES)
