import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark, sf):
    assert __spark_entry__.entry(spark).count() > 0


def test_nothing_in_the_core_names_the_llm_package():
    for p in Path(ROOT, "dialoom").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "dialoom.llm" not in p.read_text(), p


def test_core_imports_without_the_llm_package():
    code = "import sys; sys.modules['dialoom.llm'] = None; import __spark_entry__ as e; assert 'p4_found' in e.queries() and 'p1_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
