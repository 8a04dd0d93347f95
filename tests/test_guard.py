"""The library and its queries work without the text operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..")


def test_entry_without_the_text_operators(tmp_path):
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(ROOT, "demandframe"), tmp_path / "demandframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    n, sql, text = said.stdout.split()
    assert int(n) > 100 and int(sql) > 100 and text == "False"


def test_nothing_else_imports_the_text_operators():
    for folder, _, names in os.walk(os.path.join(ROOT, "demandframe")):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    assert "demandframe.llm" not in open(os.path.join(folder, n)).read(), n
