"""Splits, folds and samples decided by a digest of the row id.

The same id and seed always give the same answer, whatever the partitioning,
executor losses or task retries; no random generator is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vereda.operators.stats import attach_row, rank_within, range_slices
from vereda.session import materialize

HEX_DIGITS = 4


def digest(id_col: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))


def digest_fraction(d: Column) -> Column:
    """The first 32 bits of a digest as a number in [0, 1)."""
    return F.conv(F.substring(d, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def split_by_hash(df: DataFrame, id_col: str, test: float = 0.2, seed: int = 42, name: str = "is_test") -> DataFrame:
    """Approximate split without any shuffle: each row decides for itself."""
    return df.withColumn(name, digest_fraction(digest(id_col, seed)) < F.lit(test))


def _smallest_share(df: DataFrame, group: str, id_col: str, share: float) -> DataFrame:
    """Per group the digest of the last row of its smallest ``ceil(share * n)``.

    Pass one counts rows per (group, digest prefix). That finds the prefix the
    cut falls in. Pass two ranks only the rows with that prefix, about one in
    ``16 ** HEX_DIGITS``.
    """
    sizes = df.groupBy(group, F.substring("_d", 1, HEX_DIGITS).alias("_slice")).agg(F.count("*").alias("n"))
    all_of = W.partitionBy(group)
    upto = all_of.orderBy("_slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    cut = (
        sizes.withColumn("need", F.ceil(F.sum("n").over(all_of) * F.lit(share)))
        .withColumn("cum", F.sum("n").over(upto))
        .where((F.col("cum") >= F.col("need")) & (F.col("cum") - F.col("n") < F.col("need")))
        .select(
            F.col(group).alias("_g"),
            F.col("_slice").alias("_s"),
            (F.col("need") - (F.col("cum") - F.col("n"))).alias("_k"),
        )
    )
    # one row per group, written so that its size is known and the scan is not shuffled
    cut = materialize(cut, "cut")
    edge = df.join(
        cut, F.col(group).eqNullSafe(F.col("_g")) & (F.substring("_d", 1, HEX_DIGITS) == F.col("_s"))
    ).select("_g", "_d", F.col(id_col).alias("_id"), "_k")
    rn = F.row_number().over(W.partitionBy("_g").orderBy("_d", "_id"))
    return edge.withColumn("_rn", rn).where(F.col("_rn") == F.col("_k")).select(
        "_g", F.struct("_d", "_id").alias("_cut")
    )


def split_random(df: DataFrame, id_col: str, test: float = 0.2, seed: int = 42, name: str = "is_test") -> DataFrame:
    """Exact split: the ``ceil(test * n)`` smallest digests are the test rows."""
    marked = df.withColumn("_d", digest(id_col, seed)).withColumn("_all", F.lit(0))
    cut = _smallest_share(marked, "_all", id_col, test).select("_cut._d", "_cut._id")
    out = attach_row(marked, cut, "_cut")
    return out.withColumn(
        name, F.struct(F.col("_d"), F.col(id_col).alias("_id")) <= F.struct("_cut._d", "_cut._id")
    ).drop("_d", "_all", "_cut")


def split_stratified(
    df: DataFrame, id_col: str, label: str, test: float = 0.2, seed: int = 42, name: str = "is_test"
) -> DataFrame:
    """Exact split within each class. One row per class is written out and joined
    back, so its size is known and the rows themselves are not shuffled while
    the classes stay below the broadcast threshold."""
    marked = df.withColumn("_d", digest(id_col, seed))
    cuts = materialize(_smallest_share(marked, label, id_col, test), "cuts")
    return (
        marked.join(cuts, F.col(label).eqNullSafe(F.col("_g")), "left")
        .withColumn(name, F.struct(F.col("_d"), F.col(id_col).alias("_id")) <= F.col("_cut"))
        .drop("_d", "_g", "_cut")
    )


def assign_folds(
    df: DataFrame, id_col: str, label: str, k: int = 5, seed: int | None = 42, name: str = "fold"
) -> DataFrame:
    """Stratified folds 0..k-1: members of a class are dealt out in turn, in
    digest order, or in order of the padded id when ``seed`` is None."""
    if seed is None:
        return _folds_in_order(df, id_col, label, k, name)
    marked = df.withColumn("_d", digest(id_col, seed))
    ranked = rank_within(marked, label, "_d", id_col, "_rank")
    return ranked.withColumn(name, ((F.col("_rank") - 1) % k).cast("int")).drop("_d", "_rank")


def _folds_in_order(df: DataFrame, id_col: str, label: str, k: int, name: str) -> DataFrame:
    """Unshuffled folds: each class is cut, in id order, into k runs whose sizes
    differ by at most one. Ids are range-partitioned first, and each
    (class, range) is ranked on its own."""
    marked = range_slices(df, [id_col], "_slice")
    sizes = marked.groupBy(label, "_slice").agg(F.count("*").alias("n"))
    before = W.partitionBy(label).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(label).alias("_g"),
        F.col("_slice").alias("_s"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"),
        F.sum("n").over(W.partitionBy(label)).alias("_n"),
    )
    rn = F.row_number().over(W.partitionBy(label, "_slice").orderBy(id_col))
    rank = F.col("_before") + F.col("_rn") - 1
    small, extra = F.expr(f"_n div {k}"), F.col("_n") % k
    # the first ``extra`` runs hold one member more
    big_rows = extra * (small + 1)
    fold = F.when(rank < big_rows, F.floor(F.try_divide(rank, small + 1))).otherwise(
        extra + F.floor(F.try_divide(rank - big_rows, small))
    )
    return (
        marked.withColumn("_rn", rn)
        .join(offsets, F.col(label).eqNullSafe(F.col("_g")) & (F.col("_slice") == F.col("_s")))
        .withColumn(name, fold.cast("int"))
        .drop("_slice", "_rn", "_g", "_s", "_before", "_n")
    )


def bounded_sample(df: DataFrame, id_col: str, n: int = 1000, seed: int = 42) -> DataFrame:
    """``min(n, rows)`` rows with the smallest digests: a top-k, no full sort."""
    return df.withColumn("_d", digest(id_col, seed)).orderBy("_d", id_col).limit(n).drop("_d")


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """Examples in a stated order."""
    return df.orderBy(*order).limit(n)
