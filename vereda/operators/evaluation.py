"""Classifier metrics as aggregates over prediction rows.

Every metric first collapses the rows to counts (per class pair, per distinct
score), which needs one shuffle of counts, whatever the number of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from vereda.operators.stats import ROWS_PER_TASK, attach_row, running_totals


def confusion_counts(df: DataFrame, y: str, pred: str, keys: list[str] = []) -> DataFrame:
    """(y, y_pred, n) per key, only pairs that occur."""
    return df.groupBy(*keys, F.col(y).alias("y"), F.col(pred).alias("y_pred")).agg(F.count("*").alias("n"))


def binary_metrics(df: DataFrame, y: str, pred: str, keys: list[str] = []) -> DataFrame:
    """tn, fp, fn, tp, accuracy, precision, recall, f1_score for labels 0/1.
    A metric without a denominator is 0."""
    def hits(t, p):
        return F.count_if((F.col(y) == t) & (F.col(pred) == p))

    counts = df.groupBy(*keys).agg(
        hits(0, 0).alias("tn"), hits(0, 1).alias("fp"), hits(1, 0).alias("fn"), hits(1, 1).alias("tp")
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return counts.select(
        *keys, "tn", "fp", "fn", "tp",
        ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def class_rows(df: DataFrame, y: str, pred: str, keys: list[str] = []) -> DataFrame:
    """(label, support, precision, recall, f1_score): one row per class that
    occurs as truth or as prediction."""
    pairs = confusion_counts(df, y, pred, keys)
    sides = pairs.select(
        *keys,
        F.inline(
            F.array(
                F.struct(
                    F.col("y").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(F.col("y") == F.col("y_pred"), F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("y_pred").alias("label"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        ),
    )
    sums = sides.groupBy(*keys, "label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return sums.select(
        *keys, "label", "support",
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1_score"),
        F.col("hits").alias("hits"),
    )


def macro_metrics(df: DataFrame, y: str, pred: str, keys: list[str] = []) -> DataFrame:
    """accuracy and plain means over classes of precision, recall and F1."""
    rows = class_rows(df, y, pred, keys)
    return rows.groupBy(*keys).agg(
        F.coalesce(F.try_divide(F.sum("hits"), F.sum("support")), F.lit(0.0)).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1_score").alias("f1_macro"),
    )


def class_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Class rows followed by accuracy, macro average and weighted average."""
    rows = class_rows(df, y, pred)
    body = rows.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1_score", "support")
    total = F.sum("support")
    share = F.try_divide(F.sum("hits"), total)
    summary = rows.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("label"),
                share.alias("precision"), share.alias("recall"), share.alias("f1_score"), total.alias("support"),
            ),
            F.struct(
                F.lit("macro avg").alias("label"),
                F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                F.avg("f1_score").alias("f1_score"), total.alias("support"),
            ),
            F.struct(
                F.lit("weighted avg").alias("label"),
                *[
                    F.try_divide(F.sum(F.col(m) * F.col("support")), total).alias(m)
                    for m in ("precision", "recall", "f1_score")
                ],
                total.alias("support"),
            ),
        ).alias("s")
    ).select(F.inline("s"))
    return body.unionByName(summary)


def score_totals(
    df: DataFrame, y: str, score: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """(score, pos, neg, cum_pos, cum_neg): counts per distinct score and
    running totals from the highest score down."""
    counts = (
        df.where(F.col(score).isNotNull() & F.col(y).isNotNull())
        .groupBy((-F.col(score).cast("double")).alias("_down"))
        .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    )
    totals = running_totals(counts, "_down", ["pos", "neg"], rows_per_task)
    return totals.select((-F.col("_down")).alias("score"), "pos", "neg", "cum_pos", "cum_neg")


def roc_auc(df: DataFrame, y: str, score: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(positives, negatives, roc_auc) by the rank sum with ties counted half;
    NULL when a class is missing. The ordering step sees distinct scores only."""
    t = score_totals(df, y, score, rows_per_task)
    below = F.col("negatives") - F.col("cum_neg")
    totals = t.agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    t = attach_row(t, totals, "_t").select("*", "_t.positives", "_t.negatives")
    wins = F.sum(F.col("pos").cast("double") * (below + F.col("neg") / 2))
    return t.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        wins.alias("_wins"),
    ).select(
        "positives",
        "negatives",
        F.try_divide("_wins", F.col("positives").cast("double") * F.col("negatives")).alias("roc_auc"),
    )


def roc_points(df: DataFrame, y: str, score: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, highest first."""
    t = score_totals(df, y, score, rows_per_task)
    totals = t.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return attach_row(t, totals, "_t").select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_neg"), F.col("_t.n")).alias("fpr"),
        F.try_divide(F.col("cum_pos"), F.col("_t.p")).alias("tpr"),
    )


def fold_summary(folds: DataFrame, score: str = "f1_score", name: str = "cv_f1") -> DataFrame:
    """Mean and population deviation of one score over folds."""
    return folds.agg(F.avg(score).alias(f"{name}_mean"), F.stddev_pop(score).alias(f"{name}_std"))


def split_gap(df: DataFrame, y: str, pred: str, is_test: str) -> DataFrame:
    """(metric, train, test, gap) for a table that holds both splits."""
    names = ["accuracy", "precision", "recall", "f1_score"]
    both = binary_metrics(df, y, pred, [is_test]).unpivot([is_test], names, "metric", "value")
    wide = both.groupBy("metric").agg(
        F.max(F.when(~F.col(is_test), F.col("value"))).alias("train"),
        F.max(F.when(F.col(is_test), F.col("value"))).alias("test"),
    )
    return wide.withColumn("gap", F.col("train") - F.col("test"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
