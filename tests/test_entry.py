"""The driver contract holds without the training-data operators too."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.modules["turnfold.llm"] = None
sys.modules["corpus_pipeline"] = None
import __spark_entry__ as e
q, sql = e.queries(), e.oracle_sql()
assert "match_state_summary" in q and "pipeline" not in q and not [k for k in q if k.startswith("op1_")]
assert set(sql) <= set(q)
"""


def test_entry_without_the_subpackage():
    subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, check=True, timeout=120)


def test_every_sql_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
