"""The corpus operators in the driver's entry."""

import os
import subprocess
import sys

import __spark_entry__ as entry

HERE = os.path.dirname(os.path.abspath(entry.__file__))


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert {"op5_license_scan", "op6_quality_rules", "op8_line_dedup", "op13_conversation_trie"} <= set(entry.oracle_sql())


def test_a_missing_library_is_not_hidden():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; e.queries()"
    run = subprocess.run([sys.executable, "-c", code], cwd=HERE, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": HERE})
    assert run.returncode and "xxhash" in run.stderr
