"""Streaming query (X01): a recipe + model fitted on a batch, applied to a file stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from faro.operators import models as K
from faro.operators.recipe import Recipe
from faro.plans.registry import query
from faro.session import checkpoint_dir
from faro.sources.tables import Tables
from faro.streaming.score import file_stream, score_stream


def fitted_event_scorer(spark, d):
    """Purchase-vs-other logistic model on (value, hour), value normalised by a recipe."""
    ev = Tables(spark, d).events.withColumn("hour", F.hour("ts")).withColumn(
        "is_purchase", F.when(F.col("event_type") == "purchase", "yes").otherwise("no"))
    pr = Recipe("is_purchase", ids=["event_id"], predictors=["value", "hour"]).step_normalize(["value"]).prep(ev)
    fit = K.fit(K.logistic_reg(), pr.bake(ev), "is_purchase", ["value", "hour"], ["no", "yes"])

    def score(df):
        x = df.withColumn("hour", F.hour("ts")).withColumn(
            "is_purchase", F.when(F.col("event_type") == "purchase", "yes").otherwise("no"))
        return fit.predict(pr.bake(x)).select("event_id", "pred_class", "pred_yes")

    return score


@query("x01_score_stream")
def x01_score_stream(spark, d):
    score = fitted_event_scorer(spark, d)
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    stream = file_stream(spark, f"{d}/events*.parquet", schema, base_path=d)
    base = f"{checkpoint_dir(spark).rstrip('/')}/x01_{uuid.uuid4().hex}"
    q = score_stream(stream, score, f"{base}/out", checkpoint=f"{base}/ck", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")
