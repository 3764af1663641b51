"""Saved models and their registry."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.config import JobConfig
from tidegate.sources.tables import append_rows


def save_model(
    spark: SparkSession,
    cfg: JobConfig,
    model: PipelineModel,
    root: str,
    window: tuple[dt.date, dt.date],
    train_rows: int,
    eval_rows: int,
    eval_roc_auc: float | None,
) -> str:
    """Save under a new version, then point the name at it.

    Overwriting a model in place would lose it when the save fails; here the
    registry row, written last, is what replaces the old model.
    """
    version = uuid.uuid4().hex
    path = f"{root}/{cfg.model_name}/{version}"
    model.write().save(path)
    now = dt.datetime.now(dt.timezone.utc)
    row = (cfg.model_name, version, path, *window, train_rows, eval_rows, eval_roc_auc, now)
    append_rows(spark, spark.createDataFrame([row], schemas.MODEL_REGISTRY), cfg.registry_table)
    return path


def current_models(registry: DataFrame) -> DataFrame:
    """The newest registration of each model name."""
    rest = [c for c in registry.columns if c not in ("model_name", "registered_at")]
    newest = registry.groupBy("model_name").agg(F.max(F.struct("registered_at", *rest)).alias("m"))
    return newest.select("model_name", "m.*")


def load_model(spark: SparkSession, cfg: JobConfig) -> PipelineModel:
    named = current_models(spark.table(cfg.registry_table)).where(F.col("model_name") == cfg.model_name)
    found = named.select("path").collect()
    if not found:
        raise LookupError(f"no model registered under {cfg.model_name!r}")
    return PipelineModel.load(found[0]["path"])
