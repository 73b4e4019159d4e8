"""The registry must import, and every oracle resolve, without Spark's jars or a session."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_fresh_process_import_with_hidden_jars():
    code = ("import glob; glob.glob = lambda *a, **k: []\n"
            "import __spark_entry__ as e\n"
            "q, o = e.queries(), e.oracle_sql()\n"
            "assert len(q) >= 222 and len(o) >= 182, (len(q), len(o))\n"
            "assert all(isinstance(s, str) for s in o.values())\n")
    r = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert r.returncode == 0, r.stderr[-2000:]
