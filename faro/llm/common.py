"""Helpers shared by the operators: staged tables, ASCII lower case, hash splits, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faro.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage for wide rows (a checkpoint would store them
    uncompressed); the table survives lost executors.  ``unstage`` removes
    the tables of a session.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/faro-stage/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(spark: SparkSession) -> None:
    """Delete every table that ``stage`` wrote in this session (call when all results are consumed)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/faro-stage/{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (shared folder) of a table of short rows."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does the same, faster, where a text has no other character."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def id_crc(c: str | Column) -> Column:
    """crc32 of an id as text; a missing id counts as the empty text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (case-insensitive)."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name += "_"
    return name


def row_keys(df: DataFrame) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of all columns: equal exactly for repeated rows (nulls told apart)."""
    cols = [F.struct(F.col(f"`{c}`"), F.col(f"`{c}`").isNull()) for c in df.columns]
    return F.xxhash64(F.lit(11), *cols), F.xxhash64(F.lit(23), *cols)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph: rows (node, root), root = smallest reachable node.

    ``edges`` has long columns ``a`` and ``b`` (loops and repeats allowed).
    Alternating large-star and small-star rounds; every round is two
    aggregations to a minimum per node (partial, so a hub is no hot task) and
    joins that AQE may split.  Only edges are moved, nothing is collected.
    """
    spark = edges.sparkSession
    e = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        e = cut(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == now:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def star(n: int, i, j):
    """Smallest index reachable from each of 0..n-1 by the links (i[k], j[k]): numpy label propagation."""
    import numpy as np

    root = np.arange(n)
    while len(i):
        m = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def spans_of(text: str, size: int = 1 << 20):
    """Cut a long text into parts of about ``size`` characters that end at white space (one part if it is short)."""
    lo = 0
    while len(text) - lo > size:
        hi = lo + size
        while hi < len(text) and not text[hi].isspace():
            hi += 1
        yield text[lo:hi]
        lo = hi
    yield text[lo:] if lo else text


def word_codes(text: str | None):
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8, and a number for each (equal words, equal numbers, from 0)."""
    import numpy as np

    words = (text or "").encode().split()      # bytes split at exactly these six characters
    seen: dict[bytes, int] = {}
    return words, np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))


def sample_rate(n: int, most: int) -> float:
    """Share of ``n`` rows that keeps the expected number at ``most``."""
    return 1.0 if n <= most else most / n


def hash_sample(key: Column, rate: Column) -> Column:
    """True for a fixed pseudo-random share of the rows, by the hash of ``key``."""
    return F.pmod(F.xxhash64(F.lit(77), key), F.lit(1 << 20)) < rate * (1 << 20)
