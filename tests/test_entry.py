"""The entry must work without the optional text part."""

import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
LIST = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def core_names() -> tuple[list[str], list[str]]:
    from checks.registry import QUERIES, SQL

    text = {n for n in QUERIES if n == "pipeline" or n.startswith("op") and n[2].isdigit()}
    return sorted(set(QUERIES) - text), sorted(set(SQL) - text)


@pytest.mark.parametrize("how", ["folders deleted", "tokenizers hidden"])
def test_entry_without_the_text_part(tmp_path, how):
    import __spark_entry__  # noqa: F401  (registers all queries)

    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    if how == "folders deleted":
        for folder in ("urbanspark/llm", "tests/llm"):
            shutil.rmtree(copy / folder, ignore_errors=True)
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    else:
        (copy / "public_tokenizers.py").write_text("raise ModuleNotFoundError('hidden')\n")
    env = {**os.environ, "PYTHONPATH": str(copy)}
    done = subprocess.run([sys.executable, "-c", LIST], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    names, sqls = json.loads(done.stdout.splitlines()[-1])
    expected, expected_sqls = core_names()
    assert names == expected and sqls == expected_sqls
