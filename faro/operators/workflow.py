"""Workflows (K11, K16, V08): a recipe and a model specification fitted and applied as one.

``fit`` preps the recipe on the training rows only, so a workflow fitted
inside a fold never sees the rows it is judged on.  Prediction is the
recipe's projection followed by the model's transform: no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from faro.operators import metrics as M
from faro.operators.models import Fitted, ModelSpec, fit
from faro.operators.recipe import Recipe


@dataclass(frozen=True)
class Workflow:
    """A recipe and a model; ``levels`` = [negative, event] for classification."""

    recipe: Recipe
    spec: ModelSpec
    levels: Sequence | None = None

    def set(self, **params) -> "Workflow":
        """The finalised workflow: the model's parameters replaced by the chosen ones."""
        return replace(self, spec=self.spec.set(**params))

    def fit(self, train: DataFrame) -> "FittedWorkflow":
        prepped = self.recipe.prep(train)
        return _fit_baked(self, prepped, prepped.bake(train))


@dataclass
class FittedWorkflow:
    workflow: Workflow
    prepped: object
    model: Fitted

    def predict(self, df: DataFrame) -> DataFrame:
        """The baked rows (ids, outcome, predictors) with the model's prediction columns."""
        return self.model.predict(self.prepped.bake(df))

    def evaluate(self, test: DataFrame) -> DataFrame:
        """(metric, estimate): accuracy and ROC AUC, or the regression metrics."""
        p, y = self.predict(test), self.workflow.recipe.outcome
        if self.workflow.spec.mode == "regression":
            return M.to_long(M.regression_metrics(p, y, "pred"), ["rmse", "mae", "mse", "rsq", "rsq_trad"])
        event = self.workflow.levels[1]
        both = M.accuracy(p, y, "pred_class").select("accuracy").crossJoin(M.roc_auc(p, y, f"pred_{event}", event))  # one row each
        return M.to_long(both, ["accuracy", "roc_auc"])


def _fit_baked(wf: Workflow, prepped, baked: DataFrame) -> FittedWorkflow:
    features = [c for c in baked.columns if c != wf.recipe.outcome and c not in wf.recipe.ids]
    return FittedWorkflow(wf, prepped, fit(wf.spec, baked, wf.recipe.outcome, features, wf.levels))


def last_fit(wf: Workflow, train: DataFrame, test: DataFrame) -> DataFrame:
    """Fit on all training rows, metrics on the test rows."""
    return wf.fit(train).evaluate(test)


def batch_models(recipe: Recipe, specs: Mapping[str, ModelSpec], train: DataFrame, test: DataFrame,
                 levels: Sequence | None = None) -> DataFrame:
    """(model, metric, estimate) of several models on one recipe, which is prepped and baked once for all fits."""
    prepped = recipe.prep(train)
    baked = prepped.bake(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fits = {name: _fit_baked(Workflow(recipe, spec, levels), prepped, baked) for name, spec in specs.items()}
    finally:
        baked.unpersist()
    return M.metric_set({name: f.evaluate(test) for name, f in fits.items()})
