"""Job: area suitability (indicators in; scores, labels, models, importances out)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame, functions as F

from vereda.operators import attribution as at, evaluation as ev, models as md, scoring as sc
from vereda.operators.quality import area_key, require_rows, resolve_features
from vereda.operators.sampling import split_stratified
from vereda.operators.stats import attach_row
from vereda.session import materialize


@dataclass
class AreaResult:
    features: list[str]
    weights: DataFrame
    summary: DataFrame
    scored: DataFrame
    models: dict[str, Model]
    metrics: DataFrame
    roc: DataFrame
    importances: DataFrame
    attributions: DataFrame


def run(
    df: DataFrame, target: str = "target", boost_rounds: int = 250, trees: int = 300, folds: int = 5,
    attribution_rows: int | None = None, permutations: int = 8,
) -> AreaResult:
    df = area_key(require_rows(df, "no areas given"))
    cols = resolve_features(df, target)
    weights = materialize(sc.critic_weights(df, cols), "weights")
    scored = materialize(sc.weighted_score(df, weights, cols), "scored")
    labelled = sc.balanced_label(scored, threshold_col="critic_threshold")
    facts = labelled.agg(
        F.max("critic_threshold").alias("threshold"), F.count("*").alias("labelled_rows"),
        F.avg("target").alias("positive_rate"),
    )
    summary = attach_row(weights.select("indicator", "weight"), facts, "_f").select("indicator", "weight", "_f.*")
    chosen = labelled.drop("critic_threshold") if target not in df.columns else scored
    final = sc.ensure_label(df, chosen, target).withColumn("suitability_score", F.col("nprv_score"))
    if target in df.columns:
        final = final.drop("nprv_score")
    final = materialize(final, "scored")

    flat = md.training_frame(final, "ageb_id", cols, "target")
    split = materialize(split_stratified(flat, "ageb_id", "label"), "split")
    train, test = split.where("not is_test").drop("is_test"), split.where("is_test").drop("is_test")
    estimators = {"boosted": md.boosted(rounds=boost_rounds), "random_forest": md.area_forest(trees=trees)}
    fitted = md.train_all(estimators, train)
    metrics, roc, importances, attributions = [], [], [], []
    for name, model in fitted.items():
        cv = ev.fold_summary(md.cross_validate_f1(estimators[name], train, "ageb_id", k=folds))
        row = attach_row(md.evaluate(model, test), cv, "_cv")
        tag = F.lit(name).alias("model")
        metrics.append(row.select(tag, "*", "_cv.*").drop("_cv"))
        roc.append(ev.roc_points(md.predictions(model, test), "label", "score").select(tag, "*"))
        importances.append(md.feature_importance(model, cols).select(tag, "*"))
        sampled = at.shapley_sampling(train, model, cols, "ageb_id", attribution_rows, permutations)
        attributions.append(at.attribution_summary(sampled).select(tag, "*"))
    return AreaResult(
        cols, weights, summary, final, fitted, ev.union_all(metrics), ev.union_all(roc),
        ev.union_all(importances), ev.union_all(attributions),
    )
