"""Sinks: Parquet or CSV folders, JSON metrics, replaced tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

# fixed values: columns of a stored review file, in order
REVIEW_FILE_COLUMNS = ["company", "review_title", "pros", "cons", "source_url", "page_number"]


def write_parquet(df: DataFrame, path: str, partition_by: list[str] = []) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts with headers. Nested columns become JSON text;
    quotes are doubled so the reader above gets the same values back."""
    nested = (StructType, ArrayType, MapType)
    flat = df.select(
        *[
            F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
    flat.write.mode("overwrite").options(header=True, quote='"', escape='"', emptyValue="").csv(path)


def write_reviews(df: DataFrame, path: str) -> None:
    missing = [c for c in REVIEW_FILE_COLUMNS if c not in df.columns]
    filled = df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df
    write_csv(filled.select(*REVIEW_FILE_COLUMNS), path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a table of the catalog, in the warehouse or in a folder of its own."""
    writer = df.write.mode("overwrite").option("overwriteSchema", True)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def replace_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    df.write.mode("overwrite").format("jdbc").options(url=url, dbtable=table, **options).save()
