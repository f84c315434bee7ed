"""The driver's contract."""

import re
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_imports_without_a_session():
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert q and set(o) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_nothing_else_imports_the_corpus_operators():
    for p in (ROOT / "tickframe").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT / "tickframe").parts:
            assert not re.search(r"\bllm\b", p.read_text()), p
