import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_runs(spark):
    m = _entry()
    df = m.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert set(df.columns) == {"grp", "roc_auc"}


def test_oracle_keys_subset_of_queries():
    m = _entry()
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 200
    # every oracle is a SELECT/WITH statement
    assert all(s.lstrip().upper().startswith(("SELECT", "WITH")) for s in o.values())
