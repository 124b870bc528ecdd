"""The entry module imports and builds its SQL where Spark's jars are not beside the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_jars(tmp_path):
    code = (f"import pyspark; pyspark.__file__ = {str(tmp_path / '__init__.py')!r}\n"
            "import __spark_entry__ as e\n"
            "assert len(e.queries()) >= 92 and len(e.oracle_sql()) >= 80\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120,
                          env=os.environ | {"PYTHONPATH": ROOT, "SPARK_HOME": str(tmp_path)})
    assert done.returncode == 0, done.stderr[-2000:]


def test_queries_do_not_need_the_sql_texts():
    code = ("import sys, __spark_entry__ as e\ne.queries()\n"
            "assert not any(m.split('.')[0] == 'oracles' for m in sys.modules)\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
