"""The driver's contract, with and without the training-data subpackage."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_names():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert sql.keys() <= queries.keys() and len(queries) > 70


def test_without_llm(tmp_path):
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['evigraph.llm'] = None\n"
        "import __spark_entry__ as e; q = e.queries(); assert 'd17_disagreement' in q and not any(k.startswith('op') for k in q); e.oracle_sql()"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_entry(spark):
    got = entry.entry(spark)
    assert got.count() == 50 and "conflicting" in got.columns
