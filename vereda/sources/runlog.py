"""Run records: an append-only table of parameters, metrics and artifacts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BooleanType, MapType, NumericType, StringType, StructType

RUN_SCHEMA = (
    "run_id string, parent_id string, run_name string, kind string, key string, "
    "num_value double, str_value string, logged_at timestamp"
)


def new_run_id() -> str:
    return uuid.uuid4().hex


def leaf_paths(schema: StructType, prefix: str = "") -> list[tuple[str, object]]:
    """(dotted path, type) of every leaf of nested structs; arrays and maps are
    leaves."""
    out = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, StructType):
            out.extend(leaf_paths(f.dataType, path + "."))
        else:
            out.append((path, f.dataType))
    return out


def _numbers(schema: StructType, above: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Names from the top down to each numeric leaf; a name may hold dots."""
    out: list[tuple[str, ...]] = []
    for f in schema.fields:
        if isinstance(f.dataType, StructType):
            out.extend(_numbers(f.dataType, (*above, f.name)))
        elif isinstance(f.dataType, (NumericType, BooleanType)):
            out.append((*above, f.name))
    return out


def _quoted(names: tuple[str, ...]) -> Column:
    return F.col(".".join("`" + n.replace("`", "``") + "`" for n in names))


def flatten_metrics(payload: DataFrame, keys: list[str] = []) -> DataFrame:
    """(keys, path, value): numeric leaves of nested structs, truth values as 1 and 0, nulls dropped.
    The paths come from the schema, so one projection does it for any depth."""
    schema = StructType([f for f in payload.schema.fields if f.name not in keys])
    leaves = [
        F.struct(F.lit(".".join(names)).alias("path"), _quoted(names).cast("double").alias("value"))
        for names in _numbers(schema)
    ]
    if not leaves:
        raise ValueError("payload has no numeric entry")
    return payload.select(*keys, F.inline(F.array(*leaves))).where("value is not null")


def parse_payload(df: DataFrame, json_col: str, keys: list[str] = []) -> DataFrame:
    """Nested columns out of JSON text, with the schema found over all rows by
    one mergeable aggregate."""
    found = df.agg(F.schema_of_variant_agg(F.parse_json(json_col)).alias("s")).first()["s"]
    ddl = found.replace("OBJECT<", "STRUCT<")
    return df.select(*keys, F.from_json(json_col, ddl).alias("_p")).select(*keys, "_p.*")


def metric_entries(payload: DataFrame, run_id: str, run_name: str, parent_id: str | None = None) -> DataFrame:
    return _entries(
        flatten_metrics(payload).select(F.col("path").alias("key"), F.col("value").alias("num_value"), F.lit(None).cast("string").alias("str_value")),
        run_id, run_name, parent_id, "metric",
    )


def text_entries(
    spark: SparkSession, values: dict, run_id: str, run_name: str, kind: str = "param", parent_id: str | None = None
) -> DataFrame:
    """Parameters (``kind="param"``) or artifact paths (``kind="artifact"``)."""
    rows = [(str(k), float(v) if isinstance(v, (int, float)) else None, str(v)) for k, v in values.items()]
    df = spark.createDataFrame(rows, "key string, num_value double, str_value string")
    return _entries(df, run_id, run_name, parent_id, kind)


def _entries(df: DataFrame, run_id, run_name, parent_id, kind) -> DataFrame:
    return df.select(
        F.lit(run_id).alias("run_id"), F.lit(parent_id).cast("string").alias("parent_id"),
        F.lit(run_name).alias("run_name"), F.lit(kind).alias("kind"),
        "key", "num_value", "str_value", F.current_timestamp().alias("logged_at"),
    )


def log(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").partitionBy("run_name").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def compare_runs(runs: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per run with the named metrics as columns. The list is fixed, so
    no extra pass looks for the distinct keys."""
    return (
        runs.where((F.col("kind") == "metric") & F.col("key").isin(*metrics))
        .groupBy("run_id", "run_name")
        .pivot("key", metrics)
        .agg(F.max("num_value"))
    )


def as_json(*cols: str) -> Column:
    return F.to_json(F.struct(*cols))
