"""Contributions of features to scores: exact for linear models, sampled
Shapley values (Štrumbelj & Kononenko 2014) for any other."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from vereda.operators.sampling import bounded_sample
from vereda.operators.stats import attach_row


def linear_attribution(parts: DataFrame, id_col: str, cols: list[str], part: str = "_part") -> DataFrame:
    """(id, feature, contribution): a term of a linear score minus its mean.
    ``part`` is the struct of terms ``weight * x``."""
    means = parts.agg(*[F.avg(f"{part}.{c}").alias(c) for c in cols])
    out = attach_row(parts.select(id_col, part), means, "_mean")
    entries = [
        F.struct(F.lit(c).alias("feature"), (F.col(f"{part}.{c}") - F.col(f"_mean.{c}")).alias("contribution"))
        for c in cols
    ]
    return out.select(id_col, F.inline(F.array(*entries)))


def shapley_sampling(
    df: DataFrame, model: Model, cols: list[str], id_col: str, max_rows: int | None = None, permutations: int = 8,
    seed: int = 42, features: str = "features", background: int = 1000,
) -> DataFrame:
    """(id, feature, contribution) for all rows, or for ``max_rows`` of them.

    Each row meets ``permutations`` background rows and as many feature orders.
    The hybrids (a prefix of the order from the row, the rest from the
    background) are built as arrays and scored by one ``transform``; a feature
    gets the change it makes when it joins, averaged. Contributions of a row sum
    to its score minus the mean score of its background rows.
    """
    k = len(cols)
    asked = df if max_rows is None else bounded_sample(df, id_col, max_rows, seed)
    rows = asked.select(
        F.col(id_col).alias("_id"), vector_to_array(features).alias("x")
    )
    # the background is a sample of bounded size, in one row
    pool = bounded_sample(df, id_col, background, seed + 1).select(vector_to_array(features).alias("b"))
    pool = pool.agg(F.sort_array(F.collect_list("b")).alias("pool"))
    runs = attach_row(rows, pool, "_p").withColumn("p", F.explode(F.sequence(F.lit(1), F.lit(permutations))))

    def h(*parts):
        return F.xxhash64(*[F.lit(p) if isinstance(p, int) else p for p in parts])

    pick = F.pmod(h(seed, F.col("_id"), F.col("p")), F.size("_p.pool")).cast("int")
    order = F.transform(
        F.array_sort(
            F.transform(
                F.sequence(F.lit(0), F.lit(k - 1)),
                lambda j: F.struct(F.xxhash64(F.lit(seed), F.col("_id"), F.col("p"), j).alias("h"), j.alias("j")),
            )
        ),
        lambda s: s["j"],
    )
    runs = runs.select("_id", "x", "p", F.get("_p.pool", pick).alias("b"), order.alias("order"))
    steps = runs.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(k))))
    hybrid = F.transform(
        "x",
        lambda v, i: F.when(F.array_position(F.slice("order", 1, F.col("step")), i) > 0, v).otherwise(
            F.get("b", i)
        ),
    )
    scored = model.transform(
        steps.select("_id", "p", "step", "order", array_to_vector(hybrid).alias(features))
    ).select("_id", "p", "step", "order", vector_to_array("probability")[1].alias("s"))
    # the k + 1 scores of one run come together again
    joined = scored.groupBy("_id", "p").agg(
        F.array_sort(F.collect_list(F.struct("step", "s"))).alias("scores"), F.first("order").alias("order")
    )
    names = F.array(*[F.lit(c) for c in cols])
    changes = F.transform(
        "order",
        lambda j, i: F.struct(
            F.get(names, j).alias("feature"),
            (F.get("scores", i + 1)["s"] - F.get("scores", i)["s"]).alias("change"),
        ),
    )
    return (
        joined.select("_id", F.inline(changes))
        .groupBy(F.col("_id").alias(id_col), "feature")
        .agg(F.avg("change").alias("contribution"))
    )


def attribution_summary(contributions: DataFrame) -> DataFrame:
    """(feature, mean_abs, mean), most influential first."""
    return (
        contributions.groupBy("feature")
        .agg(F.avg(F.abs("contribution")).alias("mean_abs"), F.avg("contribution").alias("mean"))
        .orderBy(F.desc("mean_abs"), "feature")
    )
