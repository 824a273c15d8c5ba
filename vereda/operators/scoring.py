"""CRITIC objective weights, weighted scores and balance labels.

CRITIC (Diakoulaki, Mavrotas, Papayannakis 1995): the weight of an indicator
is proportional to its deviation times its summed disagreement, one minus the
correlation, with every other indicator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vereda.functions.numeric import coerce_double, minmax, threshold_label
from vereda.operators.quality import filled_columns, require_columns, require_some_value
from vereda.operators.stats import attach_row, column_facts, column_struct, medians

from vereda.session import materialize


def indicator_columns(df: DataFrame, cols: list[str], impute: bool = True):
    """(facts, expressions): the indicators as doubles, medians in place of
    missing values. Costs one pass, and one more only if something is missing."""
    require_columns(df, cols, "indicator columns")
    facts = column_facts(df, cols)
    if not impute:
        return facts, {c: coerce_double(F.col(c)) for c in cols}
    require_some_value(cols, facts)
    return facts, filled_columns(df, cols, facts)


def correlation_row(x: DataFrame, cols: list[str], gaps: set[str] | None = None) -> DataFrame:
    """One row, one pass: ``sd_<i>`` and, per pair i < j, ``r_<i>_<j>``.

    Correlations are pairwise complete; an undefined one counts as 0. ``gaps``
    names the columns that may hold nulls (all, if not given): only a pair with
    a gap needs deviations of its own. Columns are numbered, so any column name
    is safe.
    """
    gaps = set(cols) if gaps is None else gaps
    k = len(cols)
    numbered = x.select(*[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(cols)])

    def deviation(i, j):
        """Of column i over the rows where column j is present."""
        return f"stddev_pop(if(x{j} is null, null, x{i}))" if cols[j] in gaps else f"stddev_pop(x{i})"

    return numbered.selectExpr(
        *[f"stddev_pop(x{i}) as sd_{i}" for i in range(k)],
        *[
            f"coalesce(try_divide(covar_pop(x{i}, x{j}), {deviation(i, j)} * {deviation(j, i)}), 0D) as r_{i}_{j}"
            for i in range(k)
            for j in range(i + 1, k)
        ],
    )


def critic_weights(
    df: DataFrame,
    cols: list[str],
    impute: bool = True,
    normalize: bool = False,
    on_zero: str = "uniform",
) -> DataFrame:
    """(indicator, std, conflict, score, weight), one row per indicator.

    ``normalize`` takes deviations of min-max values, so that units do not
    decide. ``on_zero`` says what weights become when no indicator varies:
    ``uniform`` or ``null``.
    """
    facts, x = indicator_columns(df, cols, impute)
    gaps = set() if impute else {c for i, c in enumerate(cols) if facts[f"n_{i}"] < facts["rows"]}
    k = range(len(cols))
    # correlations do not depend on scale, so min-max values need no second pass
    spans = [float((facts[f"hi_{i}"] or 0.0) - (facts[f"lo_{i}"] or 0.0)) if normalize else 1.0 for i in k]
    disagreement = {i: " + ".join(f"(1 - r_{min(i, j)}_{max(i, j)})" for j in k if j != i) or "0D" for i in k}
    row = correlation_row(df.select(*[x[c].alias(c) for c in cols]), cols, gaps).selectExpr(
        *[f"coalesce(try_divide(sd_{i}, {spans[i]!r}D), 0D) as std_{i}" for i in k],
        *[f"{disagreement[i]} as conflict_{i}" for i in k],
    )
    scored = row.selectExpr("*", *[f"greatest(std_{i} * conflict_{i}, 0D) as score_{i}" for i in k])
    totals = scored.selectExpr("*", " + ".join(f"score_{i}" for i in k) + " as total")
    entries = [
        column_struct(
            ["indicator", "std", "conflict", "score"],
            [F.lit(c), F.col(f"std_{i}"), F.col(f"conflict_{i}"), F.col(f"score_{i}")],
        )
        for i, c in enumerate(cols)
    ]
    fallback = F.lit(1.0 / len(cols)) if on_zero == "uniform" else F.lit(None).cast("double")
    return totals.select("total", F.inline(F.array(*entries))).select(
        "indicator", "std", "conflict", "score",
        F.when(F.col("total") > 0, F.try_divide("score", "total")).otherwise(fallback).alias("weight"),
    )


def weight_row(weights: DataFrame, cols: list[str]) -> DataFrame:
    """The weight table as one row; an indicator without a weight gets 0."""
    return weights.agg(
        *[
            F.coalesce(F.max(F.when(F.col("indicator") == c, F.col("weight"))), F.lit(0.0)).alias(c)
            for c in cols
        ]
    )


def weighted_parts(df: DataFrame, weights: DataFrame, cols: list[str]) -> DataFrame:
    """``df`` with ``_part``: a struct of weight times min-max value per indicator.

    A median lies inside the range of its column, so the range of the usable
    values is the range after imputation.
    """
    facts, x = indicator_columns(df, cols)
    out = attach_row(df, weight_row(weights, cols), "_w")
    parts = [
        F.col(f"_w.{c}") * minmax(x[c], F.lit(facts[f"lo_{i}"]), F.lit(facts[f"hi_{i}"]))
        for i, c in enumerate(cols)
    ]
    return out.withColumn("_part", column_struct(cols, parts)).drop("_w")


def weighted_score(
    df: DataFrame, weights: DataFrame, cols: list[str], score_col: str = "nprv_score"
) -> DataFrame:
    """Add the weighted sum of min-max indicators, a number in [0, 1]."""
    out = weighted_parts(df, weights, cols)
    total = sum((F.col(f"_part.{c}") for c in cols[1:]), F.col(f"_part.{cols[0]}"))
    return out.withColumn(score_col, total).drop("_part")


def balanced_label(
    df: DataFrame,
    score_col: str = "nprv_score",
    threshold: float | None = None,
    label_col: str = "target",
    threshold_col: str | None = None,
) -> DataFrame:
    """1 where the score reaches the threshold, by default the exact median.
    ``threshold_col`` also keeps the threshold that was used."""
    require_columns(df, [score_col], "score column")
    if threshold is None:
        out = attach_row(df, medians(df, [score_col]), "_t")
        used = F.col(f"_t.{score_col}")
    else:
        out, used = df, F.lit(float(threshold))
    out = out.withColumn(label_col, threshold_label(F.col(score_col), used))
    if threshold_col:
        out = out.withColumn(threshold_col, used)
    return out.drop("_t")


def critic_summary(df: DataFrame, cols: list[str], threshold: float | None = None, **options):
    """(labelled rows, summary). The summary has one row per indicator with its
    weight, and on each the threshold, the row count and the positive rate."""
    weights = materialize(critic_weights(df, cols, **options), "weights")
    scored = materialize(weighted_score(df, weights, cols), "scored")
    labelled = balanced_label(scored, threshold=threshold, threshold_col="_threshold")
    facts = labelled.agg(
        F.max("_threshold").alias("threshold"),
        F.count("*").alias("labelled_rows"),
        F.avg("target").alias("positive_rate"),
    )
    summary = attach_row(weights.select("indicator", "weight"), facts, "_f").select(
        "indicator", "weight", "_f.threshold", "_f.labelled_rows", "_f.positive_rate"
    )
    return labelled.drop("_threshold"), summary


def ensure_label(df: DataFrame, scored: DataFrame, target: str = "target") -> DataFrame:
    """Use computed labels only when the target is missing, and always end up
    with a column named ``target``. Decided on the schema, no job."""
    if target not in df.columns:
        return scored
    return scored if target == "target" else scored.withColumn("target", F.col(target))


def area_indicators(
    base: DataFrame,
    components: dict[str, DataFrame],
    mapping: dict[str, list[list[str]]],
    key: str = "ageb_id",
) -> DataFrame:
    """Assemble indicators from component tables keyed by area.

    ``mapping`` gives per indicator a list of terms that are added; each term
    is a list of columns of which the first non-null counts, 0 if none is.
    """
    out = base
    for table in components.values():
        out = out.join(table, key, "left")
    terms = {
        name: sum(
            (F.coalesce(*[F.col(c).cast("double") for c in term], F.lit(0.0)) for term in parts[1:]),
            F.coalesce(*[F.col(c).cast("double") for c in parts[0]], F.lit(0.0)),
        )
        for name, parts in mapping.items()
    }
    return out.select(*base.columns, *[t.alias(n) for n, t in terms.items()])
