"""Sources: CSV with common missing-value tokens, SQL text, tables, a chain of
fallbacks, nested Parquet on object storage."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import StringType, StructType

from vereda.functions.numeric import nan_to_null

# fixed values: texts that stand for a missing value in CSV files
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

#: lines of a split that are put in order at once
PIECE_LINES = 4096


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the records of a CSV file or folder without its headers; a quoted field
    may hold line breaks, which become line feeds.

    Files are read in splits, line by line, and splits are cut into pieces of ``PIECE_LINES``
    lines, which bounds what a task sorts. A line begins a record if the quotes before
    it, in its own piece and in the pieces before it, are even in number. Only lines of
    records of several lines are moved, to be put together.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), "value",
    )
    piece = ["file", "split", "piece"]
    # the id's lower bits number the lines that a task reads
    lines = lines.withColumn("piece", F.floor(F.col("at") / PIECE_LINES))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    in_piece = W.partitionBy(*piece).orderBy("at")
    earlier = in_piece.rowsBetween(W.unboundedPreceding, -1)
    # one row a piece from here on
    pieces = lines.groupBy(*piece).agg((F.sum(odd) % 2).alias("odd"))
    in_file = W.partitionBy("file").orderBy("split", "piece")
    before = in_file.rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select(
        *piece, (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("inside"),
        ((F.col("split") == 0) & (F.row_number().over(in_file) == 1)).alias("top"),
    )
    placed = lines.join(pieces, piece).withColumn(
        "starts", (F.col("inside") + F.coalesce(F.sum(odd).over(earlier), F.lit(0))) % 2 == 0
    )
    begun = F.max(F.when(F.col("starts"), F.col("at")))
    placed = placed.withColumn("first", begun.over(in_piece.rowsBetween(W.unboundedPreceding, W.currentRow)))
    # what begins in one piece may end in the next ones
    ends = placed.groupBy(*piece).agg(F.max("first").alias("last"))
    carry = F.last("last", ignorenulls=True).over(before)
    ends = ends.select(*piece, carry.alias("carried"))
    placed = placed.join(ends, piece).withColumn("record", F.coalesce("first", "carried"))
    header = F.col("top") & (F.row_number().over(in_piece) == 1)
    follows = F.lead("starts").over(in_piece)
    placed = placed.withColumn("header", header).withColumn("alone", F.col("starts") & F.coalesce(follows, F.lit(False)))
    alone = placed.where("alone and not header").select(F.col("value").alias("record"))
    parts = placed.where("not alone").groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("split", "at", "value"))).alias("lines"), F.max("header").alias("header")
    )
    joined = parts.where("not header").select(F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("record"))
    return alone.unionByName(joined).where("record <> ''")


def _csv_text(spark: SparkSession, path: str, schema: StructType | None, multi_line: bool) -> DataFrame:
    """All columns as text."""
    reader = spark.read.options(header=True, quote='"', escape='"', encoding="UTF-8")
    names = [f.name for f in schema.fields] if schema is not None else reader.csv(path).columns
    text = StructType()
    for name in names:
        text = text.add(name, StringType())
    if not multi_line:
        return reader.schema(text).option("enforceSchema", schema is None).csv(path)
    ddl = ", ".join(f"`{name}` string" for name in names)
    parsed = F.from_csv("record", ddl, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    return csv_records(spark, path).select(parsed.alias("r")).select("r.*")


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = True
) -> DataFrame:
    """A CSV file or folder with a header; quoted fields may hold line breaks. Large
    files are read in splits either way; turn ``multi_line`` off for files without line
    breaks in fields, which saves putting records together.

    With a schema values are converted to it and unconvertible ones become
    NULL. Without one a single pass decides per column between long, double,
    boolean and string.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    text = _csv_text(spark, path, schema, multi_line)
    clean = text.select(
        *[F.when(~F.col(f"`{c}`").isin(*NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in text.columns]
    )
    if schema is not None:
        return clean.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])

    kinds = ["bigint", "double", "boolean"]
    checks = []
    for i, c in enumerate(clean.columns):
        col = F.col(f"`{c}`")
        checks.append(F.count(col).alias(f"n_{i}"))
        for kind in kinds:
            fits = col.try_cast(kind).isNotNull()
            if kind == "boolean":
                fits = F.lower(col).isin("true", "false")
            if kind == "bigint":
                fits = fits & col.rlike(r"^\s*[-+]?\d+\s*$")
            checks.append(F.count_if(fits).alias(f"{kind}_{i}"))
    seen = clean.agg(*checks).first()
    out = []
    for i, c in enumerate(clean.columns):
        n = seen[f"n_{i}"]
        kind = next((k for k in kinds if n and seen[f"{k}_{i}"] == n), "string")
        col = F.col(f"`{c}`").try_cast(kind)
        out.append((nan_to_null(col) if kind == "double" else col).alias(c))
    return clean.select(*out)


def read_sql(spark: SparkSession, query: str) -> DataFrame:
    return spark.sql(query)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, partition: dict | None = None, **options) -> DataFrame:
    """An external database table. ``partition`` (column, lowerBound,
    upperBound, numPartitions) makes the scan parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition:
        reader = reader.options(
            partitionColumn=partition["column"], lowerBound=partition["lowerBound"],
            upperBound=partition["upperBound"], numPartitions=partition["numPartitions"],
        )
    return reader.load()


def load_input(spark: SparkSession, where: str, schema: StructType | str | None = None) -> DataFrame:
    """``sql:<query>``, ``table:<name>``, or the path of a Parquet or CSV input."""
    if where.startswith("sql:"):
        return read_sql(spark, where[len("sql:"):].strip())
    if where.startswith("table:"):
        return read_table(spark, where[len("table:"):].strip())
    if where.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(where)
    return read_csv(spark, where, schema)


def first_nonempty(loaders: Iterable[Callable[[], DataFrame]], message: str = "No input found") -> DataFrame:
    """The first source that exists and has a row. Only a missing or invalid
    source is passed over; any other failure is raised."""
    for load in loaders:
        try:
            df = load()
            if not df.isEmpty():
                return df
        except AnalysisException:
            continue
    raise ValueError(message)


# fixed values: the point-of-interest categories kept by default
POI_CATEGORIES = ("retail", "food_and_drink", "social")


def read_pois(spark: SparkSession, uri: str, categories: tuple[str, ...] = POI_CATEGORIES) -> DataFrame:
    """(id, name, category, x, y) from nested Parquet. Only the needed leaves of
    ``names`` and ``categories`` are read, and the filters reach the scan."""
    return select_pois(spark.read.parquet(uri), categories)


def select_pois(raw: DataFrame, categories: tuple[str, ...] = POI_CATEGORIES) -> DataFrame:
    return raw.where(
        F.col("categories.primary").isin(*categories) & F.col("x").isNotNull() & F.col("y").isNotNull()
    ).select(
        "id", F.col("names.primary").alias("name"), F.col("categories.primary").alias("category"), "x", "y"
    )


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, "company string, url string")


def enrich(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Left join to a side table such as company facts. The planner broadcasts
    the side table when its size allows."""
    return df.join(other, key, "left")
