"""Exact nearest neighbours by blocks along a curve: brute force, ties, hot points, work per query."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faro.operators import models as K
from faro.operators import neighbours as N


def frames(spark, train, queries):
    t = spark.createDataFrame([(i, v if v is None else [None if c is None else float(c) for c in v], float(i % 7)) for i, v in enumerate(train)], "_n long, _nv array<double>, _t double")
    q = spark.createDataFrame([(i, v if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(queries)], "_q long, _qv array<double>")
    return q, t


def brute(train, queries, k):
    whole = lambda v: v is not None and all(c is not None and c == c for c in v)
    out = set()
    for qi, q in enumerate(queries):
        if not whole(q):
            continue
        d = sorted((float(np.sqrt(sum((np.float64(a) - np.float64(b)) ** 2 for a, b in zip(q, v)))), i) for i, v in enumerate(train) if whole(v) and len(v) == len(q))
        out |= {(qi, i, r) for r, (_, i) in enumerate(d[:k], start=1)}
    return out


def found(df):
    return {(r["_q"], r["_n"], r["_r"]) for r in df.collect()}


@pytest.mark.parametrize("dims,k", [(1, 1), (1, 6), (2, 3), (3, 5), (12, 4)])
def test_equals_brute_force(spark, monkeypatch, dims, k):
    monkeypatch.setattr(N, "ROWS", 16)
    monkeypatch.setattr(N, "FAN", 3)
    rng = np.random.default_rng(dims * 10 + k)
    train = [*rng.normal(size=(300, dims)), *(rng.normal(size=(80, dims)) * 1e-3 + 5), *rng.integers(0, 3, size=(120, dims))]     # a dense spot, and ties
    train = [list(v) for v in train] + [[1e6] * dims, [-1e9] * dims, None, [None] * dims, [float("nan")] * dims]
    queries = [list(v) for v in (*rng.normal(size=(40, dims)), *rng.integers(0, 3, size=(20, dims)), *(rng.normal(size=(10, dims)) * 50))] + [None, [float("nan")] * dims, train[0], train[0]]
    q, t = frames(spark, train, queries)
    assert found(N.nearest(q, t, k)) == brute(train, queries, k)


def test_hot_points_small_tables_and_no_rows(spark):
    train = [[0.0, 0.0]] * 500 + [[float(i), 1.0] for i in range(30)]
    queries = [[0.0, 0.0]] * 50 + [[29.0, 1.2]]
    q, t = frames(spark, train, queries)
    assert found(N.nearest(q, t, 4)) == brute(train, queries, 4)
    index = N.Index(q, t, 4)
    assert index.n == 4 + 30 and index.asked.count() == 2            # copies are reduced on both sides
    assert found(N.nearest(q, t.limit(3), 9)) and len(found(N.nearest(q, t.limit(3), 9))) == 51 * 3
    assert N.nearest(q, t.limit(0), 2).count() == 0 and N.nearest(q.limit(0), t, 2).count() == 0


def compared(index):
    """Rows a query is compared with, on average."""
    per = {r["block"]: r["n"] for r in index.rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    own = sum(per.get(r["block"] + s, 0) for r in index.asked.collect() for s in (-1, 0, 1))
    more = sum(per[r["block"]] for r in index.pairs(index.near()).collect())
    return (own + more) / index.asked.count()


@pytest.mark.parametrize("dims", [1, 2])
def test_work_per_query_does_not_grow_with_the_table(spark, dims):
    rng = np.random.default_rng(3)
    queries = list(map(list, rng.random((60, dims))))
    work = []
    for n in (4_000, 40_000):
        train = spark.range(n).select(F.col("id").alias("_n"), F.array(*[F.rand(7 + i) for i in range(dims)]).alias("_nv"), F.lit(0.0).alias("_t"))
        work.append(compared(N.Index(frames(spark, [[0.0]], queries)[0], train, 5)))
    assert work[1] < 1.5 * work[0] and work[1] < 0.1 * 40_000


def test_plan_has_no_cross_join(spark, monkeypatch):
    monkeypatch.setattr(N, "ROWS", 4)
    monkeypatch.setattr(N, "FAN", 2)
    rng = np.random.default_rng(1)
    q, t = frames(spark, list(map(list, rng.random((200, 2)))), list(map(list, rng.random((20, 2)))))
    plan = N.nearest(q, t, 3)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "Join Cross" not in plan


def test_imputation_leaves_rows_without_features(spark):
    df = spark.createDataFrame([(1, 1.0, 10.0), (2, 2.0, 20.0), (3, 1.4, None), (4, None, None), (5, 9.0, 90.0)], "id int, x double, y double")
    got = {r["id"]: r["y"] for r in K.knn_impute(df, "id", "y", ["x"], k=2).collect()}
    assert got == {1: 10.0, 2: 20.0, 3: 15.0, 4: None, 5: 90.0}


def test_cosine_search_is_the_same_with_and_without_broadcast(spark, monkeypatch):
    from faro.operators import text as TX

    rng = np.random.default_rng(9)
    v = spark.createDataFrame([(i, list(map(float, rng.normal(size=3)))) for i in range(120)], "id long, v array<double>")
    want = TX.cosine_topk(v, v.withColumnRenamed("id", "c"), "id", "c", "v", "v", 4, exclude_self=True).collect()
    monkeypatch.setattr(TX, "MOST_BROADCAST", 10)
    got = TX.cosine_topk(v, v.withColumnRenamed("id", "c"), "id", "c", "v", "v", 4, exclude_self=True).collect()
    key = lambda rows: {(r["id"], r["rank"]): (r["neighbor"], round(r["similarity"], 9)) for r in rows}
    assert key(got) == key(want) and len(got) == 480
