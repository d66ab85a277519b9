import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_a_session():
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr[-500:]
    n, m = map(int, said.stdout.split())
    assert n >= 80 and m >= 80


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
