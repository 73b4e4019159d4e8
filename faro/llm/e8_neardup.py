"""Embedding near-duplicates by E8 lattice hashing.

Every vector is projected at random to eight dimensions in ``tables``
independent tables and decoded to its E8 cell (its home); it also probes the
``probes`` neighbouring cells that lie closest.  A pair meets where one
vector's home is a home or probed cell of the other; met pairs are verified
by cosine in double precision.

Scale: exact copies collapse to one class first, so a hot vector is one row.
A cell is cut into a grid of blocks of about ``block`` homes x ``block``
visitors, so no task holds more than two blocks whatever a cell's size.  Per
block only sums and star edges leave the task (linear in its rows, never the
pairs): a pair that meets several times is counted at its first meeting,
which both vectors' lattice codes tell without any exchange.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faro.llm import e8
from faro.llm.common import components, cut, star

SEED = 20117


def projections(dim: int, tables: int, cell: float) -> np.ndarray:
    """tables x dim x 8: orthonormal directions, scaled so that distances are kept on average, in units of a cell."""
    out = []
    for t in range(tables):
        rng = np.random.default_rng([SEED, dim, t])
        q, _ = np.linalg.qr(rng.normal(size=(max(dim, 8), 8)))
        out.append(q[:dim] * np.sqrt(max(dim, 8) / 8.0) / cell)
    return np.stack(out)


def _mix(codes: np.ndarray, table: int, dim: int) -> np.ndarray:
    """64-bit name of a lattice point of a table (codes ... x 8 int16)."""
    with np.errstate(over="ignore"):
        h = np.full(codes.shape[:-1], (table + 1) * 1_000_003 + dim, dtype=np.uint64)
        for k in range(8):
            h = (h ^ codes[..., k].astype(np.int64).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h.view(np.int64)


def unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cells(x: np.ndarray, tables: int, probes: int, cell: float) -> np.ndarray:
    """n x tables x (1 + probes) cell names of unit vectors; position 0 is the home."""
    p = projections(x.shape[1], tables, cell)
    out = np.empty((len(x), tables, probes + 1), dtype=np.int64)
    for t in range(tables):
        y = x @ p[t]
        home = e8.decode(y)
        out[:, t, 0] = _mix(home, t, x.shape[1])
        if probes:
            out[:, t, 1:] = _mix(e8.neighbours(y, home, probes), t, x.shape[1])
    return out


def _emit(tables: int, probes: int, cell: float):
    def run(batches):
        for b in batches:
            for _, part in b.groupby(b["e"].map(len)):
                for lo in range(0, len(part), 2000):
                    p = part.iloc[lo:lo + 2000]
                    c = cells(unit(list(p["e"])), tables, probes, cell).reshape(len(p), -1)
                    k = c.shape[1]
                    yield pd.DataFrame({
                        "cell": c.ravel(), "home": np.tile((np.arange(k) % (probes + 1) == 0), len(p)),
                        "cid": np.repeat(p["cid"].to_numpy(), k)})

    return run


def _first_meeting(ci: np.ndarray, cj: np.ndarray, i: np.ndarray, j: np.ndarray, here: np.ndarray, forward: np.ndarray) -> np.ndarray:
    """For met pairs (visitor i, home j): is this cell where the pair is to be counted?

    Meetings are ordered by table, then by direction (the visitor with the
    smaller class id first).  ``here`` is this cell's table per pair.
    """
    seen = np.zeros(len(i), dtype=bool)
    for t in range(ci.shape[1]):
        a = (cj[j, t, :1] == ci[i, t]).any(axis=1)   # i visits j's home
        b = (ci[i, t, :1] == cj[j, t]).any(axis=1)   # j visits i's home
        seen |= (t < here) & (a | b)
        seen |= (t == here) & ~forward & b           # the other direction, from the smaller id, comes first
    return ~seen


def _verify(tables: int, probes: int, cell: float, threshold: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        name = key[0]
        pdf = pdf.drop_duplicates(["cid", "home"])
        x = unit(list(pdf["e"]))
        cid, w, home = pdf["cid"].to_numpy(), pdf["n"].to_numpy(), pdf["home"].to_numpy()
        h, v = np.flatnonzero(home), np.arange(len(pdf))
        v = v[(pdf["qb"].to_numpy() == key[2])]
        h = h[(pdf["hb"].to_numpy()[h] == key[1])]
        n_out, edges = np.zeros(len(pdf), dtype=np.int64), []
        codes = None
        for lo in range(0, len(v), 1024):
            vi = v[lo:lo + 1024]
            a, b = np.nonzero(x[vi] @ x[h].T >= threshold)
            i, j = vi[a], h[b]
            keep = cid[i] != cid[j]
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            if codes is None:
                codes = cells(x, tables, probes, cell)
                table = int((codes[h[0], :, 0] == name).argmax())
            forward = cid[i] < cid[j]
            first = _first_meeting(codes, codes, i, j, np.full(len(i), table), forward)
            i, j = i[first], j[first]
            np.add.at(n_out, i, w[j])
            np.add.at(n_out, j, w[i])
            edges.append((i, j))
        if not edges:
            return pd.DataFrame({"cid": [], "links": [], "to": []}).astype("int64")
        i, j = (np.concatenate(z) for z in zip(*edges))
        root = star(len(pdf), i, j)
        least = np.full(len(pdf), np.iinfo(np.int64).max)
        np.minimum.at(least, root, cid)
        at = np.flatnonzero(n_out)
        return pd.DataFrame({"cid": cid[at], "links": n_out[at], "to": least[root[at]]})

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9,
                    tables: int = 4, probes: int = 16, cell: float = 0.45, block: int = 2000) -> DataFrame:
    """One row per input row: (id, n_links, component_id, kept).

    ``n_links`` counts the other rows with cosine >= ``threshold`` that the
    hashing finds (at the threshold itself about 0.99 of them with the
    default parameters, nearer pairs practically always; none below it),
    ``component_id`` is the smallest id reachable by links.  A cell length of
    0.45 and 16 of the 240 neighbours were chosen by simulation.

    Edge cases: vectors that are null, empty, zero or hold null or non-finite
    components, and vectors of different lengths, do not link; a row without
    links has component_id = its id and is kept.  Equal vectors always link
    (cosine one), repeated rows count as rows of their own.  A null id takes
    part but names a component only if no other id does.  Other columns are
    not read; an empty table gives an empty result.
    """
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("e"))
    bad = F.exists("e", lambda z: z.isNull() | F.isnan(z) | (F.abs(z) == float("inf")))
    ok = F.coalesce(~bad & F.exists("e", lambda z: z != 0), F.lit(False))
    src = src.withColumn("e", F.when(ok, F.transform("e", lambda z: z + F.lit(0.0))))
    k1, k2 = F.xxhash64(F.lit(1), "e"), F.xxhash64(F.lit(2), "e")
    rows = src.select("vec_id", k1.alias("k1"), k2.alias("k2"), F.col("e").isNotNull().alias("ok"))
    # classes of equal vectors (128-bit name); the class id is given once, in a written table
    cls = (src.filter("e is not null").groupBy(k1.alias("k1"), k2.alias("k2"))
           .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("e").alias("e")))
    cls = cut(cls.withColumn("cid", F.monotonically_increasing_id()))
    spots = (cls.select("cid", "e").mapInPandas(_emit(tables, probes, cell), "cell long, home boolean, cid long"))
    size = spots.groupBy("cell").agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("all"))
    size = size.filter((F.col("homes") > 0) & (F.col("all") > 1)) \
               .select("cell", F.ceil(F.col("homes") / block).cast("int").alias("nh"), F.ceil(F.col("all") / block).cast("int").alias("nq"))
    part = spots.join(size, "cell").join(cls.select("cid", "e", "n"), "cid")
    b = F.pmod(F.xxhash64("cid"), F.lit(1 << 30)).cast("int")
    part = part.withColumn("own_h", F.pmod(b, F.col("nh"))).withColumn("own_q", F.pmod(b, F.col("nq")))
    # a home stands in its row of the grid (every column), every vector of the cell also in its column as a visitor
    as_home = part.filter("home").withColumn("q", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))) \
                  .select("cell", F.col("own_h").alias("gh"), F.col("q").alias("gq"), "cid", "n", "e", "home",
                          F.col("own_h").alias("hb"), F.col("own_q").alias("qb"))
    as_visitor = part.withColumn("h", F.explode(F.sequence(F.lit(0), F.col("nh") - 1))) \
                     .filter(~F.col("home") | (F.col("h") != F.col("own_h"))) \
                     .select("cell", F.col("h").alias("gh"), F.col("own_q").alias("gq"), "cid", "n", "e", F.lit(False).alias("home"),
                             F.lit(-1).alias("hb"), F.col("own_q").alias("qb"))
    found = cut(as_home.unionByName(as_visitor).withColumn("e", F.col("e").cast("array<float>") if _is_float(vectors, vector_col) else F.col("e"))
                .groupBy("cell", "gh", "gq").applyInPandas(_verify(tables, probes, cell, threshold), "cid long, links long, to long"))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("cid").alias("a"), F.col("to").alias("b")))
    named = cls.select("cid", "k1", "k2", "n", "least").join(links, "cid", "left").join(comp.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.withColumn("root", F.coalesce("root", "cid"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("k1", "k2", F.lit(True).alias("ok"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component_id")
    out = rows.join(named, ["k1", "k2", "ok"], "left")
    comp_id = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"),
                      F.coalesce(F.col("vec_id") == comp_id, F.lit(True)).alias("kept"))


def _is_float(df: DataFrame, col: str) -> bool:
    return dict(df.dtypes)[col] == "array<float>"
