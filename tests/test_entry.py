import subprocess
import sys

import __spark_entry__ as entry


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"lang", "clean", "contaminated"} <= set(rows[0].asDict())


def test_sql_names_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_a_session():
    assert subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries(); e.oracle_sql()"], capture_output=True).returncode == 0
