"""The entry module with and without the corpus folder."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract

REPO = Path(contract.__file__).parent


@pytest.mark.parametrize("leftovers", [False, True])
def test_entry_works_without_the_corpus_folder(tmp_path, leftovers):
    shutil.copytree(REPO / "netvigil", tmp_path / "netvigil", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    if leftovers:
        (tmp_path / "netvigil/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True,
                          env={"PATH": "/usr/bin:/bin"})
    queries, statements = done.stdout.splitlines()[-2:]
    assert "ip_risk_scores" in queries.split() and "pipeline" not in queries.split()
    assert not [name for name in queries.split() if name.startswith("op")]
    assert set(statements.split()) <= set(queries.split())


def test_entry_works_without_a_library_of_the_corpus_folder(tmp_path):
    """A module that raises on import stands for a library that is not installed."""
    shutil.copytree(REPO / "netvigil", tmp_path / "netvigil", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    (tmp_path / "netvigil/llm").mkdir()
    (tmp_path / "netvigil/llm/__init__.py").write_text("")
    (tmp_path / "netvigil/llm/registry.py").write_text("import no_such_library\n")
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_library\n")
    code = "import __spark_entry__ as e; print(*e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True,
                          env={"PATH": "/usr/bin:/bin"})
    assert "ip_risk_scores" in done.stdout.split() and "no_such_library" in done.stderr
