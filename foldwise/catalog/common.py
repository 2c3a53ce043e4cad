"""Shared inputs of the registered queries (Spark side of ``catalog.sql``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.operators.foldstats import train_eval_frame
from foldwise.operators.folds import assign_folds
from foldwise.plans.joins import persisted
from foldwise.sources.tables import observations

K = 5
SEED = 42


def split(spark, sf_dir):
    """(obs, train rows with fold, test rows). The fold-numbered training table feeds every fit
    of a query, so it is materialised once (persisted, recomputable from lineage)."""
    obs = observations(spark, sf_dir)
    tr = persisted(assign_folds(obs.where(F.col("side") == "train"), "label", "id", k=K, seed=SEED))
    te = obs.where(F.col("side") == "test")
    return obs, tr, te


def applied(spark, sf_dir):
    """(train-with-fold, rows to transform tagged with eval_fold)."""
    _, tr, te = split(spark, sf_dir)
    return tr, train_eval_frame(tr, te, "fold")
