import re
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_the_entry_imports_without_the_training_data_subpackage(tmp_path):
    for name in ("gritmill", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", str(ROOT / name), str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "gritmill" / "llm")], check=True)
    code = "import __spark_entry__ as e; assert 'kw_clean' in e.queries() and not any(n.startswith('op') for n in e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "gritmill").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"^\s*(from|import) .*\bllm\b", p.read_text(), re.M)
