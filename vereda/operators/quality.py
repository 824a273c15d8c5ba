"""Checks, profiles, duplicate removal, imputation, feature resolution."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from vereda.functions.numeric import coerce_double, map_values
from vereda.functions.text import is_blank
from vereda.operators.stats import attach_row, column_facts, medians

# fixed values: preferred indicators, and columns that are never features
PREFERRED_INDICATORS = [
    "node_connectivity",
    "place_population",
    "place_employment",
    "real_estate_proxy",
    "vitality_retail",
    "vitality_food",
    "vitality_social",
]
NEVER_FEATURES = {"ageb_id", "station_id", "nearest_node", "geometry", "label", "balanced_label"}
AREA_KEYS = ["ageb_id", "cvegeo", "CVEGEO"]


def require_columns(df: DataFrame, cols: Iterable[str], what: str = "columns") -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"absent {what}: {missing}")
    return df


def require_rows(df: DataFrame, message: str = "table has no rows") -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def require_some_value(cols: list[str], facts) -> None:
    """Reject columns that hold no usable value at all."""
    bad = [c for i, c in enumerate(cols) if facts[f"n_{i}"] == 0]
    if bad:
        raise ValueError(f"columns without any usable value: {bad}")


def require_classes(df: DataFrame, label: str, at_least: int = 2) -> DataFrame:
    """At least one usable row and ``at_least`` distinct labels."""
    found = df.where(F.col(label).isNotNull()).select(label).distinct().limit(at_least).count()
    if found == 0:
        raise ValueError("no row carries a label")
    if found < at_least:
        raise ValueError(f"At least {at_least} classes are required")
    return df


def resolve_features(
    df: DataFrame, target: str, minimum: int = 4, preferred: Iterable[str] = tuple(PREFERRED_INDICATORS),
    never: Iterable[str] = frozenset(NEVER_FEATURES),
) -> list[str]:
    """The first choice of feature columns that has at least ``minimum`` of them.

    Choices are the ``preferred`` names, then all numbers but ``target`` and
    those in ``never``. Looks at the schema only.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    barred = {target, *never}
    choices = [
        [name for name in preferred if name in kinds],
        [name for name, kind in kinds.items() if isinstance(kind, NumericType) and name not in barred],
    ]
    for found in choices:
        if len(found) >= minimum:
            return found
    raise ValueError(f"too few feature columns: {minimum} are needed, the table offers {choices[-1]}")


def area_key(df: DataFrame) -> DataFrame:
    """Rename whichever accepted area key is present to ``ageb_id``."""
    for key in AREA_KEYS:
        if key in df.columns:
            return df.withColumnRenamed(key, "ageb_id")
    raise ValueError(f"No area key; expected one of {AREA_KEYS}")


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count), one pass over the table."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column_name", "null_count")


def duplicate_count(df: DataFrame) -> DataFrame:
    """(total_rows, distinct_rows, duplicate_rows).

    Rows are grouped on their columns, so equality is that of ``distinct``:
    NULL and NaN equal themselves, 0.0 equals -0.0, times count to the
    microsecond. Copies collapse before the shuffle, so a row repeated for a
    third of the table is no hot key.
    """
    return (
        df.groupBy(*[F.col(f"`{c}`") for c in df.columns])
        .agg(F.count("*").alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
            F.count("*").alias("distinct_rows"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        )
    )


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: null count, with the table's shape and duplicates."""
    shape = duplicate_count(df).select("total_rows", "duplicate_rows")
    out = attach_row(null_counts(df), shape, "_s")
    return out.select(
        "column_name",
        "null_count",
        F.col("_s.total_rows").alias("total_rows"),
        F.lit(len(df.columns)).cast("long").alias("total_columns"),
        F.col("_s.duplicate_rows").alias("duplicate_rows"),
    )


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    return df.where(~is_blank(F.col(col)))


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: coerce_double(F.col(c)) for c in cols})


def filled_columns(df: DataFrame, cols: list[str], facts) -> dict[str, Column]:
    """Expressions that replace missing numbers by the column's exact median.
    Columns without a gap cost nothing."""
    gaps = [c for i, c in enumerate(cols) if facts[f"n_{i}"] < facts["rows"]]
    middle = medians(df, gaps).first() if gaps else {}
    return {
        c: F.coalesce(coerce_double(F.col(c)), F.lit(middle[c])) if c in gaps else coerce_double(F.col(c))
        for c in cols
    }


def impute_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """Coerce to numbers and replace missing values by the exact median."""
    return df.withColumns(filled_columns(df, cols, column_facts(df, cols)))


def impute_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(coerce_double(F.col(c)), F.lit(0.0)) for c in cols})


def map_label(df: DataFrame, col: str, mapping: dict) -> DataFrame:
    """Recode a label only when it is text; unmapped text becomes NULL."""
    if not isinstance(df.schema[col].dataType, StringType):
        return df
    return df.withColumn(col, map_values(F.col(col), mapping))


def value_counts(df: DataFrame, col: str, null_as: str | None = None) -> DataFrame:
    """(value, n); missing values form a group of their own, named ``null_as``
    if given."""
    value = F.col(col)
    if null_as is not None:
        value = F.coalesce(value.cast("string"), F.lit(null_as))
    return df.groupBy(value.alias(col)).agg(F.count("*").alias("n"))


def distinct_counts(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, one row. The exact form shuffles
    one column at a time and collapses repeats first."""
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
    rows = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in cols])
        ).alias("p")
    )
    return (
        rows.where("p.v is not null")
        .select("p.k", "p.v")
        .distinct()
        .groupBy()
        .agg(*[F.count_if(F.col("k") == c).alias(c) for c in cols])
    )
