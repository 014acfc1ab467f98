"""Model versions: aliases, promotion, rollback, selection, active models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecastops.functions.keys import model_uri_part

# Aliases of a model's versions from the newest on.
CANDIDATE, PRODUCTION, BACKUP = "CANDIDATE", "PRODUCTION", "BACKUP"
ALIASES = (CANDIDATE, PRODUCTION, BACKUP)


def alias_by_recency(versions: DataFrame, model: str = "model_name", version: str = "model_version", created: str = "created_on") -> DataFrame:
    """Newest version CANDIDATE, the one before PRODUCTION, the one before that BACKUP; older ones none."""
    order = Window.partitionBy(model).orderBy(F.desc(created), F.desc(version))
    age = F.row_number().over(order)
    alias = F.get(F.array(*[F.lit(a) for a in ALIASES]), age - 1)
    return versions.withColumn("alias", alias)


def _move(aliased: DataFrame, moves: Mapping[str, str | None], which: Column | None) -> DataFrame:
    moved = F.lit(None).cast("string")
    for old, new in moves.items():
        moved = F.when(F.col("alias") == old, F.lit(new)).otherwise(moved)
    known = F.col("alias").isin(*moves)
    chosen = known if which is None else known & which
    return aliased.withColumn("alias", F.when(chosen, moved).otherwise(F.col("alias")))


def promote(aliased: DataFrame, which: Column | None = None) -> DataFrame:
    """CANDIDATE becomes PRODUCTION, PRODUCTION becomes BACKUP, BACKUP loses its alias; all models or those in ``which``."""
    return _move(aliased, {CANDIDATE: PRODUCTION, PRODUCTION: BACKUP, BACKUP: None}, which)


def roll_back(aliased: DataFrame, which: Column | None = None) -> DataFrame:
    """PRODUCTION and BACKUP change places; all models or those in ``which``."""
    return _move(aliased, {PRODUCTION: BACKUP, BACKUP: PRODUCTION}, which)


def default_versions(aliased: DataFrame, model: str = "model_name", version: str = "model_version") -> DataFrame:
    """The version a model answers with: the one in production."""
    return aliased.where(F.col("alias") == PRODUCTION).select(model, F.col(version).alias("default_version"))


def versions_to_run(aliased: DataFrame, aliases: Sequence[str], model: str = "model_name", version: str = "model_version") -> DataFrame:
    """Versions that any of the aliases or tags points at, each once."""
    return aliased.where(F.col("alias").isin(*aliases)).select(model, version).distinct()


def active_models(predictions: DataFrame, week: int, name_part: str = "", uri: str = "model_uri") -> DataFrame:
    """Distinct models with predictions in a week whose address contains ``name_part``, split into name and version."""
    seen = predictions.where((F.col("week") == week) & F.col(uri).contains(name_part)).select(uri).distinct()
    return seen.withColumns({"model_name": model_uri_part(uri, "name"), "model_version": model_uri_part(uri, "version")})
