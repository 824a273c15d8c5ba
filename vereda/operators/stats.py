"""One-row statistics as scalar subqueries, exact medians, ordered totals."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vereda.functions.numeric import coerce_double
from vereda.session import materialize

# Rows of a range that one task sorts.
ROWS_PER_TASK = 2_000_000


def attach_row(df: DataFrame, row: DataFrame, name: str) -> DataFrame:
    """Add a one-row table to every row as a struct column.

    It is a scalar subquery: computed once, shipped with the plan, no join.
    """
    return df.withColumn(name, row.select(F.struct("*")).scalar())


def column_struct(names: list[str], values: list[Column]) -> Column:
    return F.struct(*[v.alias(n) for n, v in zip(names, values)])


def range_slices(
    df: DataFrame, order: list[str], name: str, rows_per_task: int = ROWS_PER_TASK, stored: bool = False
) -> DataFrame:
    """``df`` cut into ranges of ``order``, numbered in order in column ``name``.

    Written out, because the range bounds come from a sample: every later use
    must see the same cut. A ``stored`` table is cut without being written first."""
    rows = df if stored else materialize(df, "rows")
    ranges = max(1, math.ceil(rows.count() / rows_per_task))
    return materialize(
        rows.repartitionByRange(ranges, *order).withColumn(name, F.spark_partition_id()), "ranges"
    )


def running_totals(
    df: DataFrame, order: str, sums: list[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Add ``cum_<c>``: the total of ``c`` over rows with ``order`` up to this one.

    ``order`` must be unique (aggregate by it first). The rows are cut into
    ranges of about ``rows_per_task``, each range is summed by its own task and
    the totals of the ranges before it are added, so no task sees more than its
    range.
    """
    parts = range_slices(df, [order], "_range", rows_per_task)
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.groupBy("_range").agg(*[F.sum(c).alias(c) for c in sums])
    offsets = offsets.select(
        "_range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in sums]
    )
    w = W.partitionBy("_range").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        parts.join(offsets, "_range")
        .select(*df.columns, *[(F.sum(c).over(w) + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in sums])
    )


def column_facts(df: DataFrame, cols: list[str]):
    """One pass, one row on the driver: ``rows`` and per numbered column
    ``n_<i>``, ``lo_<i>``, ``hi_<i>`` over its usable numbers."""
    numbers = df.select(*[coerce_double(F.col(c)).alias(f"x{i}") for i, c in enumerate(cols)])
    per_column = [
        f"{fn}(x{i}) as {name}_{i}"
        for i in range(len(cols))
        for fn, name in (("count", "n"), ("min", "lo"), ("max", "hi"))
    ]
    return numbers.selectExpr("count(*) as rows", *per_column).first()


def medians(
    df: DataFrame, cols: list[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Exact interpolated medians as a one-row table with the columns ``cols``.

    ``median`` would keep every distinct value of a column in one buffer. Here a
    mergeable quantile sketch brackets the middle by its error bound, the rows
    below the bracket are counted and only the values inside it are ranked.
    """
    x = df.select(*[coerce_double(F.col(c)).alias(c) for c in cols])
    accuracy = 10_000
    slack = 2.0 / accuracy
    bounds = x.agg(
        *[F.percentile_approx(c, [0.5 - slack, 0.5 + slack], accuracy).alias(c) for c in cols]
    ).first()
    counts = x.agg(
        *[F.count(c).alias(f"n_{c}") for c in cols],
        *[F.count_if(F.col(c) < bounds[c][0]).alias(f"below_{c}") for c in cols if bounds[c]],
    ).first()

    values = []
    for c in cols:
        n = counts[f"n_{c}"]
        if n == 0:
            values.append(F.lit(None).cast("double").alias(c))
            continue
        low, high = bounds[c]
        inside = (
            x.where(F.col(c).between(low, high)).groupBy(c).agg(F.count("*").alias("n"))
        )
        ranked = running_totals(inside, c, ["n"], rows_per_task)
        first, last = (n - 1) // 2, n // 2
        upto = F.col("cum_n") + F.lit(counts[f"below_{c}"])
        # a value covers the zero-based ranks [upto - n, upto)
        middle = ranked.agg(
            F.min(F.when(upto > first, F.col(c))).alias("a"),
            F.min(F.when(upto > last, F.col(c))).alias("b"),
        ).first()
        values.append(F.lit((middle["a"] + middle["b"]) / 2).alias(c))
    return df.sparkSession.range(1).select(*values)


def rank_within(
    df: DataFrame, group: str, digest: str, tie: str, name: str, hex_digits: int = 4
) -> DataFrame:
    """1-based rank inside ``group`` by a uniform hex ``digest``, ties by ``tie``.

    Rows are ranked inside (group, digest prefix) slices, and the sizes of the
    slices before are added, so a group with a third of all rows is still
    spread over ``16 ** hex_digits`` windows.
    """
    sliced = df.withColumn("_slice", F.substring(digest, 1, hex_digits))
    sizes = sliced.groupBy(group, "_slice").agg(F.count("*").alias("_n"))
    before = W.partitionBy(group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(group).alias("_g"),
        F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    w = W.partitionBy(group, "_slice").orderBy(digest, tie)
    return (
        sliced.withColumn("_rn", F.row_number().over(w))
        .join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_slice") == F.col("_s")))
        .withColumn(name, (F.col("_before") + F.col("_rn")).cast("long"))
        .drop("_slice", "_rn", "_g", "_s", "_before")
    )
