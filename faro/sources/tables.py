"""Access to the named parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


class Tables:
    """Lazy attribute access: ``Tables(spark, d).orders`` reads ``d/orders.parquet``.

    Reading is lazy in Spark, so only columns and row groups that a query
    needs are scanned (column pruning and filter pushdown reach the scan).
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        return self.__getattr__(name)
