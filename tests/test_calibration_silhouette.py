"""Isotonic calibration, Euclidean silhouettes, permutation by cyclic shifts, quoted CSV text: brute force and edge cases."""

import csv
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from faro.operators import cluster as C
from faro.operators import explain as I
from faro.operators import isotonic as ISO
from faro.sources import io as S


def isotonic(x, y):
    """Largest of the smallest means: fit at every distinct score."""
    xs = sorted(set(x))
    n = [sum(v == s for v in x) for s in xs]
    t = [sum(b for a, b in zip(x, y) if a == s) for s in xs]
    return {s: max(min(sum(t[a:b + 1]) / sum(n[a:b + 1]) for b in range(i, len(xs))) for a in range(i + 1)) for i, s in enumerate(xs)}


@pytest.mark.parametrize("range_size", [2, 5, 1000])
def test_isotonic_equals_min_max_formula_for_any_cut(spark, range_size):
    rng = np.random.default_rng(range_size)
    rows = []
    for g in ("a", "b", "c"):
        x = np.round(rng.random(60), 2)
        p = {"a": x, "b": 1 - x, "c": np.full(60, 0.5)}[g]           # rising, falling (one block), flat
        rows += [(f"{g}{i}", g, float(x[i]), int(rng.random() < p[i])) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, grp string, score double, truth int")
    got = {r["id"]: r["score_cal"] for r in ISO.calibrate_by_group(df, "truth", "score", "grp", range_size=range_size).collect()}
    for g in "abc":
        mine = [r for r in rows if r[1] == g]
        want = isotonic([r[2] for r in mine], [r[3] for r in mine])
        assert all(abs(got[r[0]] - want[r[2]]) < 1e-12 for r in mine)


def test_isotonic_of_a_long_monotone_column_is_itself(spark):
    df = spark.range(3000).select(F.col("id"), F.lit("g").alias("grp"), (F.col("id") / 3000).alias("x"), (F.col("id") + 1).alias("s"), F.lit(5000).alias("n"))
    got = ISO.isotonic_blocks(df, "grp", "x", range_size=64)
    assert got.count() == 3000                                        # no block is pooled, no range grows


def test_isotonic_edge_rows(spark):
    rows = [(1, "a", 0.2, 1), (2, "a", 0.4, 0), (3, "a", 0.1, None), (4, "a", 0.9, None), (5, None, 0.3, 1), (6, "b", 0.5, None), (7, "a", None, 1), (8, "a", float("nan"), 1)]
    df = spark.createDataFrame(rows, "id int, grp string, score double, truth int")
    got = {r["id"]: r["score_cal"] for r in ISO.calibrate_by_group(df, "truth", "score", "grp").collect()}
    assert got == {1: 0.5, 2: 0.5, 3: 0.5, 4: 0.5, 5: None, 6: None, 7: None, 8: None}
    assert ISO.calibrate_by_group(df.limit(0), "truth", "score", "grp").count() == 0


def brute_silhouette(v, lab):
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(axis=2))
    out = []
    for i in range(len(v)):
        own = lab == lab[i]
        if own.sum() <= 1:
            out.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][lab == c].mean() for c in set(lab) if c != lab[i])
        out.append((b - a) / max(a, b))
    return np.array(out)


def test_silhouette_of_all_rows_is_exact_and_a_sample_is_covered_by_its_error(spark):
    rng = np.random.default_rng(0)
    lab = np.r_[np.repeat([0, 1, 2], [200, 120, 60]), 3]
    v = rng.normal(size=(381, 5)) + lab[:, None] * 1.5
    df = spark.createDataFrame([(i, list(map(float, v[i])), int(lab[i])) for i in range(381)] + [(900, None, 1), (901, [0.0] * 5, None)], "id int, v array<double>, c int")
    want = brute_silhouette(v, lab)
    got = {r["id"]: r["silhouette"] for r in C.silhouette_euclidean(df, "id", "v", "c", sample=1000).collect()}
    assert len(got) == 381 and all(abs(got[i] - want[i]) < 1e-9 for i in got)
    whole = C.silhouette_estimate(C.silhouette_euclidean(df, "id", "v", "c", sample=1000), 381).first()
    assert whole["std_err"] == 0 and abs(whole["mean_silhouette"] - want.mean()) < 1e-9
    errors = []
    for seed in range(8):
        sil = C.silhouette_euclidean(df.repartition(5), "id", "v", "c", sample=80, seed=seed)
        part = C.silhouette_estimate(sil, 381).first()
        assert part["n"] == 80 and all(abs(r["silhouette"] - want[r["id"]]) < 1e-9 for r in sil.collect())
        errors.append(abs(part["mean_silhouette"] - want.mean()) / part["std_err"])
    assert sum(e < 2 for e in errors) >= 6 and max(errors) < 4
    with pytest.raises(ValueError):
        C.silhouette_euclidean(df, "id", "v", "c", sample=10 ** 6)
    one = C.silhouette_euclidean(df.filter("c = 1"), "id", "v", "c").select("silhouette").distinct().collect()
    assert [r[0] for r in one] == [None] and C.silhouette_euclidean(df.limit(0), "id", "v", "c").count() == 0


def test_permutations_share_one_rank_and_keep_every_value(spark):
    df = spark.createDataFrame([(i, float(i), f"s{i}", 7) for i in range(101)], "id int, x double, s string, y int")
    got = I.permuted(df, "id", ["x", "s"], n_rep=3, seed=1)
    rows = got.collect()
    assert len(rows) == 101 * 6 and got.columns == ["id", "y", "x", "s", "variable", "rep"]
    orders = set()
    for v in ("x", "s"):
        for r in (1, 2, 3):
            part = sorted((q["id"], q["x"], q["s"]) for q in rows if q["variable"] == v and q["rep"] == r)
            assert sorted(p[1] for p in part) == list(map(float, range(101))) and sorted(p[2] for p in part) == sorted(f"s{i}" for i in range(101))
            assert all((p[1] == p[0]) != (v == "x") and (p[2] == f"s{p[0]}") != (v == "s") for p in part)     # only the named column moves, and every value does
            orders.add(tuple(p[1] if v == "x" else p[2] for p in part))
    assert len(orders) == 6
    assert I.permuted(df.limit(0), "id", ["x"], 2).count() == 0


TABLES = ['id,t\n1,plain\n2,"with ""quotes"""\n', 'id,t\r\n1,"two\r\nlines"\r\n\r\n2,"a, b"\r\n', 'id,t\n1,"first\n\n""third"" line"\n2,""\n3,x"', "id,t", "", None,
          'id,t\n1,"never closed\n2,still inside']


def test_csv_text_with_quoted_line_breaks(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TABLES)], "k int, csv string")
    got = {}
    for r in S.read_csv_text(df, "csv", "id INT, t STRING", keep=["k"]).collect():
        got.setdefault(r["k"], []).append((r["id"], r["t"]))
    for k in (0, 1):
        want = [(int(a), b) for a, b in list(csv.reader(io.StringIO(TABLES[k], newline="")))[1:] if a] if k == 0 else [(1, "two\r\nlines"), (2, "a, b")]
        assert [(i, t.replace("\r\n", "\n")) for i, t in sorted(got[k])] == [(i, t.replace("\r\n", "\n")) for i, t in want]
    assert sorted(got[2])[:2] == [(1, 'first\n\n"third" line'), (2, None)] and len(got[2]) == 3
    assert 3 not in got and 4 not in got and 5 not in got
    assert len(got[6]) == 1 and got[6][0][0] == 1                     # an unclosed quote runs to the end: one record


def test_csv_text_equals_duckdb(spark, tmp_path):
    import duckdb

    rng = np.random.default_rng(2)
    fields = ["".join(rng.choice(list('ab",\n '), rng.integers(1, 12))).strip() or "z" for _ in range(200)]
    text = "id,t\n" + "".join(f'{i},"{f.replace(chr(34), chr(34) * 2)}"\n' for i, f in enumerate(fields))
    path = tmp_path / "t.csv"
    path.write_text(text)
    want = sorted(duckdb.sql(f"SELECT id, t FROM read_csv('{path}', header = true, quote = '\"', escape = '\"', columns = {{'id': 'INT', 't': 'VARCHAR'}}, delim = ',')").fetchall())
    got = S.read_csv_text(spark.createDataFrame([(text,)], "csv string"), "csv", "id INT, t STRING").collect()
    assert sorted((r["id"], r["t"]) for r in got) == want == list(enumerate(fields))
