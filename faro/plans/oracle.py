"""Run registered queries in Spark and their SQL oracle in DuckDB; compare.

Usage: ``python -m faro.plans.oracle [sf_dir] [name-prefix ...]``.
Comparison: same column names, same row count, compatible types and equal
values after sorting rows (doubles already rounded by the registry).
"""

from __future__ import annotations

import math
import sys
import time

from faro.sources.tables import TABLES

_TYPE = {
    "LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
    "BooleanType": "BOOLEAN", "DateType": "DATE", "FloatType": "FLOAT", "ShortType": "SMALLINT",
    "ByteType": "TINYINT", "TimestampType": "TIMESTAMP WITH TIME ZONE", "TimestampNTZType": "TIMESTAMP",
}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _spark_type(dt) -> str:
    name = type(dt).__name__
    if name == "ArrayType":
        return _spark_type(dt.elementType) + "[]"
    return _TYPE.get(name, name)


def compare(spark, con, q, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = q.spark(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_types = {f.name: _spark_type(f.dataType) for f in sdf.schema.fields}
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": q.name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = q.oracle()
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_types = {d[0]: str(d[1]) for d in cur.description}
    raw = cur.fetchall()
    idx = [d_cols.index(c) for c in s_cols if c in d_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in raw]
    res["oracle_rows"] = len(d_rows)
    problems = []
    if sorted(d_cols) != s_cols:
        problems.append(f"columns spark={s_cols} oracle={sorted(d_cols)}")
    else:
        bad = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
        if bad:
            problems.append(f"types {bad}")
        key = lambda r: tuple((x is None, str(type(x)), x if not isinstance(x, tuple) else str(x)) for x in r)
        a, b = sorted(s_rows, key=key), sorted(d_rows, key=key)
        if len(a) != len(b):
            problems.append(f"rows {len(a)} vs {len(b)}")
        else:
            diff = [(x, y) for x, y in zip(a, b) if x != y]
            if diff:
                problems.append(f"{len(diff)} differing rows, e.g. spark={diff[0][0]} oracle={diff[0][1]}")
    res["status"] = "ok" if not problems else "FAIL"
    if problems:
        res["problems"] = problems
    return res


def main(argv: list[str]) -> int:
    from faro.plans.registry import all_queries
    from faro.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = argv[1:]
    spark = local_session()
    con = duck(sf_dir)
    fails = 0
    for name, q in sorted(all_queries().items()):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            r = compare(spark, con, q, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "error": str(e).splitlines()[0][:300]}
        if r["status"] not in ("ok", "rows-only"):
            fails += 1
        print(r, flush=True)
    print(f"failures: {fails}")
    return 1 if fails else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
