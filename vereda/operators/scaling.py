"""Column scaling with statistics taken from the data or from training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vereda.functions.numeric import coerce_double, minmax, zscore
from vereda.operators.stats import attach_row, column_struct


def range_row(df: DataFrame, cols: list[str]) -> DataFrame:
    """Min and max per column as one row of structs."""
    x = {c: coerce_double(F.col(c)) for c in cols}
    return df.agg(
        *[column_struct(["lo", "hi"], [F.min(x[c]), F.max(x[c])]).alias(c) for c in cols]
    )


def moment_row(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and population deviation per column as one row of structs."""
    x = {c: coerce_double(F.col(c)) for c in cols}
    return df.agg(
        *[column_struct(["mean", "std"], [F.avg(x[c]), F.stddev_pop(x[c])]).alias(c) for c in cols]
    )


def minmax_scale(df: DataFrame, cols: list[str], suffix: str = "_scaled") -> DataFrame:
    out = attach_row(df, range_row(df, cols), "_r")
    return out.withColumns(
        {
            c + suffix: minmax(coerce_double(F.col(c)), F.col(f"_r.{c}.lo"), F.col(f"_r.{c}.hi"))
            for c in cols
        }
    ).drop("_r")


def zscore_scale(
    df: DataFrame, cols: list[str], suffix: str = "_scaled", fit_on: Column | None = None
) -> DataFrame:
    """Standardise every row; ``fit_on`` selects the rows the mean and the
    population deviation come from (training rows), all rows by default."""
    source = df if fit_on is None else df.where(fit_on)
    out = attach_row(df, moment_row(source, cols), "_m")
    return out.withColumns(
        {
            c + suffix: zscore(coerce_double(F.col(c)), F.col(f"_m.{c}.mean"), F.col(f"_m.{c}.std"))
            for c in cols
        }
    ).drop("_m")
