"""Model interpretation.

Permutation importance and partial dependence score one combined table:
all permuted copies (or all grid points) are unioned and passed through the
model once, then a single aggregation computes the metric per variable.
Permutations are cyclic shifts of one column along the rows' hash ranks: one
global rank and one join serve every column and repetition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faro.functions.core import hash_unit, stable_hash
from faro.operators.ranking import hash_rank, materialize


def importance_impurity(fitted) -> DataFrame:
    """Gini (impurity) importance of a tree ensemble, normalised to sum to 1."""
    from pyspark.sql import SparkSession

    imp = fitted.model.featureImportances.toArray().tolist()
    rows = sorted(zip(fitted.features, imp), key=lambda t: -t[1])
    return SparkSession.getActiveSession().createDataFrame([(n, float(v)) for n, v in rows], "variable string, importance double")


def _shift(seed: int, column: str, rep: int, n: Column) -> Column:
    """Places that a column's values move along the ranks: 1 to n - 1, from the hash of seed, column and repetition."""
    return F.floor(hash_unit(seed, F.lit(column), F.lit(str(rep))) * (n - 1)) + 1


def permuted(data: DataFrame, key: str, columns: Sequence[str], n_rep: int = 1, seed: int = 42) -> DataFrame:
    """``data`` once per column and repetition (``variable``, ``rep``) with that column's values dealt to other rows.

    Rows are ranked once by the hash of their key; a permutation is a cyclic
    shift of one column along that random order, so no value is lost or used
    twice, and one join on the rank makes all copies.
    """
    ranked = materialize(hash_rank(data.withColumn("_h", stable_hash(seed, key)), "_h", (), [key], out="_r", total="_rows").drop("_h"))
    moves = [F.struct(F.lit(c).alias("variable"), F.lit(r).alias("rep"), (F.pmod(F.col("_r") - 1 + _shift(seed, c, r, F.col("_rows")), F.col("_rows")) + 1).alias("to"),
                      *[(F.col(o) if o == c else F.lit(None).cast(data.schema[o].dataType)).alias(f"v_{o}") for o in columns])
             for c in columns for r in range(1, n_rep + 1)]
    moved = ranked.select(F.explode(F.array(*moves)).alias("m")).select("m.*").withColumnRenamed("to", "_r")
    both = ranked.drop("_rows").join(moved, "_r")
    kept = [c for c in data.columns if c not in columns]
    return both.select(*kept, *[F.when(F.col("variable") == c, F.col(f"v_{c}")).otherwise(F.col(c)).alias(c) for c in columns], "variable", "rep")


def permute_column(df: DataFrame, key: str, column: str, seed: int) -> DataFrame:
    """Same rows with ``column`` permuted (exactly: no sampling, independent of the partitioning)."""
    return permuted(df, key, [column], 1, seed).drop("variable", "rep")


def importance_permutation(data: DataFrame, key: str, columns: Sequence[str],
                           score: Callable[[DataFrame], DataFrame], metric: Callable[[DataFrame, Sequence[str]], DataFrame],
                           n_rep: int = 1, seed: int = 42) -> DataFrame:
    """Metric drop after permuting each column (``n_rep`` permutations each); all copies are scored in one pass.

    ``score(df)`` adds predictions; ``metric(scored, by)`` returns one
    ``estimate`` per ``by`` group.  Output: (variable, base, permuted, drop).
    """
    base = data.withColumn("variable", F.lit("_none_")).withColumn("rep", F.lit(0))
    u = base.unionByName(permuted(data, key, columns, n_rep, seed).select(*base.columns))
    m = metric(score(u), ["variable", "rep"])
    base = m.filter(F.col("variable") == "_none_").select(F.col("estimate").alias("base"))
    per = m.filter(F.col("variable") != "_none_").groupBy("variable").agg(F.avg("estimate").alias("permuted"))
    return per.crossJoin(base).withColumn("drop", F.col("base") - F.col("permuted"))


def partial_dependence(data: DataFrame, column: str, grid: Sequence[float], score: Callable[[DataFrame], DataFrame],
                       pred: str) -> DataFrame:
    """Mean prediction with ``column`` set to each grid value (grid broadcast, bounded)."""
    spark = data.sparkSession
    g = spark.createDataFrame([(float(v),) for v in grid], "grid_value double")
    x = data.crossJoin(F.broadcast(g)).withColumn(column, F.col("grid_value"))
    s = score(x)
    return s.groupBy("grid_value").agg(F.avg(pred).alias("mean_prediction"), F.count(F.lit(1)).alias("n"))


def rank_agreement(a: DataFrame, b: DataFrame, key: str, va: str, vb: str) -> DataFrame:
    """Spearman correlation between two rankings of the same variables (bounded by #variables)."""
    from pyspark.sql import Window

    ra = a.withColumn("_ra", F.rank().over(Window.orderBy(F.desc(va))))
    rb = b.withColumn("_rb", F.rank().over(Window.orderBy(F.desc(vb))))
    j = ra.select(key, "_ra").join(rb.select(key, "_rb"), key)
    return j.agg(F.corr(F.col("_ra").cast("double"), F.col("_rb").cast("double")).alias("spearman"),
                 F.count(F.lit(1)).alias("n_variables"))


def linear_logistic(coefs: dict[str, float], intercept: float) -> Callable[[DataFrame], DataFrame]:
    """A fixed logistic scorer p = 1 / (1 + exp(-(b0 + sum b_j x_j))) as a scoring function."""
    def score(df: DataFrame) -> DataFrame:
        eta: Column = F.lit(float(intercept))
        for c, b in coefs.items():
            eta = eta + F.lit(float(b)) * F.col(c).cast("double")
        return df.withColumn("prob", F.lit(1.0) / (F.lit(1.0) + F.exp(-eta)))
    return score
