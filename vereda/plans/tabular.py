"""Job: tabular classification (CSV or table in, metrics out)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vereda.operators import evaluation as ev, models as md
from vereda.operators.quality import drop_duplicates, map_label, require_columns, require_rows
from vereda.operators.sampling import split_random
from vereda.operators.scaling import zscore_scale
from vereda.operators.stats import attach_row
from vereda.session import materialize

# fixed values: codes of the text label
DIAGNOSIS_CODES = {"M": 1, "B": 0}


def prepare(
    df: DataFrame, id_col: str, cols: list[str], target: str = "diagnosis", codes: dict = DIAGNOSIS_CODES,
    dedupe: bool = False,
) -> DataFrame:
    """(id, features, label, is_test): labels coded, an exact hash split, and
    features standardised with the moments of the training rows."""
    require_columns(df, [id_col, target, *cols], "columns")
    if dedupe:
        df = drop_duplicates(df)
    coded = map_label(df, target, codes).where(F.col(target).isNotNull())
    split = materialize(split_random(coded, id_col), "split")
    scaled = zscore_scale(split, cols, "", fit_on=~F.col("is_test"))
    flat = md.training_frame(scaled, id_col, cols, target)
    return flat.join(split.select(id_col, "is_test"), id_col)


def run(
    df: DataFrame, id_col: str, cols: list[str], target: str = "diagnosis", codes: dict = DIAGNOSIS_CODES,
    trees: int = 100, depth: int = 30, folds: int = 5,
) -> DataFrame:
    """(model, accuracy, ..., roc_auc, cv_f1_mean, cv_f1_std), a row per model."""
    require_rows(df)
    ready = materialize(prepare(df, id_col, cols, target, codes), "tabular")
    train, test = ready.where("not is_test").drop("is_test"), ready.where("is_test").drop("is_test")
    estimators = {"logistic": md.logistic(train.count()), "rf": md.forest(trees=trees, depth=depth)}
    rows = []
    for name, model in md.train_all(estimators, train).items():
        cv = ev.fold_summary(md.cross_validate_f1(estimators[name], train, id_col, k=folds, seed=None))
        row = attach_row(md.evaluate(model, test), cv, "_cv")
        rows.append(row.select(F.lit(name).alias("model"), "*", "_cv.*").drop("_cv"))
    return ev.union_all(rows)
