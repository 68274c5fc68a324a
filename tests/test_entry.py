"""The driver's entry points."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_sql_needs_no_session_and_no_installed_jars():
    code = (
        "import pathlib, __spark_entry__ as e\n"
        "pathlib.Path.glob = pathlib.Path.rglob = None\n"
        "sql, names = e.oracle_sql(), e.queries()\n"
        "assert set(sql) <= set(names) and all(isinstance(s, str) and s for s in sql.values())\n"
        "from pyspark.sql import SparkSession\n"
        "assert SparkSession.getActiveSession() is None\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_missing_subpackage_is_left_out():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('replycast.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
        "assert 'model_data' in e.queries() and 'model_data' in e.oracle_sql()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
