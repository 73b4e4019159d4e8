"""Scoring an unbounded source with a fitted recipe and model.

Train-time state (recipe parameters, model coefficients) is fixed, so
``bake`` + ``predict`` are stateless per-row projections: each micro-batch
is scored independently, results are appended, and progress lives in the
checkpoint location, so the query resumes after a failure without
re-emitting committed batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from faro.session import checkpoint_dir


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", base_path: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if base_path:
        r = r.option("basePath", base_path)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], sink_path: str,
                 checkpoint: str | None = None, available_now: bool = False, fmt: str = "parquet") -> StreamingQuery:
    """Apply ``score`` (e.g. ``lambda df: fitted.predict(prepped.bake(df))``) to every micro-batch and
    append the results to ``sink_path``; checkpoint under ``spark.checkpoint.dir`` unless given."""
    spark = stream.sparkSession
    ck = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/score_stream/{hashlib.md5(sink_path.encode()).hexdigest()}"
    scored = score(stream)
    w = scored.writeStream.format(fmt).option("path", sink_path).option("checkpointLocation", ck).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
