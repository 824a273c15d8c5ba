"""Shards cut from a Hilbert-curve order of the documents' metadata."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType

from bindings.common import Catalog
from vereda.llm.common import documents, running
from vereda.session import materialize

catalog = Catalog()


def hilbert_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with ``bits`` bits per dimension
    (rows are points), by Skilling's transposed form (2004)."""
    x = levels.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def number(c: Column) -> Column:
    c = c.cast("double")
    return F.when(~F.isnan(c), c)


def is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, NumericType)


def string_cuts(df: DataFrame, name: str, bits: int) -> list[str]:
    """The values with which a new level begins: distinct values in order, with their
    numbers of rows, cut at the quantiles. At most ``2 ** bits - 1`` come back."""
    values = df.where(F.col(f"`{name}`").isNotNull()).groupBy(F.col(f"`{name}`").cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    values = materialize(values, "shard-values")
    total = values.agg(F.sum("n")).first()[0]
    if not total:
        return []
    level = F.expr(f"_before * {1 << bits}L div {total}L")
    inside = F.expr(f"(_before + n - 1) * {1 << bits}L div {total}L")
    placed = running(values, ["v"], F.col("n"), "shard-value-order").select("v", level.alias("low"), inside.alias("high"), "_before", "n")
    # the first value of a level: the one before it ends in a lower level
    first = placed.where("_before > 0").where(F.expr(f"(_before - 1) * {1 << bits}L div {total}L") < F.col("low"))
    # a value over several levels fills them; the next one begins a new one
    wide = placed.where("high > low").select((F.col("_before") + F.col("n")).alias("_before"))
    after = placed.join(wide, "_before").select("v")
    return sorted({r[0] for r in first.select("v").union(after).collect()}, key=lambda v: v.encode())


def below(edges: Column, v: Column, equal: bool = False) -> Column:
    """How many edges lie under ``v`` (or at it); none for NULL."""
    return F.when(v.isNull(), 0).otherwise(F.size(F.filter(edges, lambda e: e <= v if equal else e < v)))


def hilbert_order(keyed: DataFrame, dims: list[str], bits: int) -> DataFrame:
    """Adds ``hilbert``: each dimension is cut at its quantiles into at most ``2 ** bits``
    levels (NULL and NaN are the lowest), and the levels are one cell of the curve.
    Numbers are cut by a quantile sketch, other columns by their values as strings."""
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [d for d in dims if is_number(keyed, d)]
    cuts = keyed.agg(F.count(F.lit(1)), *[F.percentile_approx(number(F.col(f"`{d}`")), steps, 2000) for d in numbers]).first()
    cuts = dict(zip(numbers, cuts[1:], strict=True))
    levels = []
    for d in dims:
        if d in cuts:
            edges = F.array(*[F.lit(float(c)) for c in sorted(set(cuts[d] or []))]).cast("array<double>")
            levels.append(below(edges, number(F.col(f"`{d}`"))))
        else:
            values = string_cuts(keyed, d, bits)
            level = below(F.array(*[F.lit(v) for v in values]).cast("array<string>"), F.col(f"`{d}`").cast("string"), True)
            levels.append(F.when(F.col(f"`{d}`").isNull(), 0).otherwise(F.least(level + 1, F.lit((1 << bits) - 1))))

    @F.pandas_udf("long")
    def place(*columns: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([c.to_numpy() for c in columns], axis=1), bits))

    return keyed.withColumn("hilbert", place(*levels))


KEY = ["doc_id", "size", "text_crc32", "_hash"]


def keys(docs: DataFrame) -> list[Column]:
    """What tells rows apart; rows that are equal in all columns share it."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return [
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("_hash"),
    ]


def ranked(docs: DataFrame, dims: list[str], bits: int) -> tuple[DataFrame, int]:
    """``doc_id, size, text_crc32, _hash, hilbert, _rank`` of every row in curve order, and how many there are."""
    named = [F.col(f"`{d}`").alias(f"dim_{i}") for i, d in enumerate(dims) if d not in KEY]
    table = materialize(docs.select(*keys(docs), *named, F.monotonically_increasing_id().alias("_row")), "shard-keys")
    own = [d if d in KEY else f"dim_{i}" for i, d in enumerate(dims)]
    ordered = materialize(hilbert_order(table, own, bits).select(*KEY, "_row", "hilbert"), "shard-curve")
    total = ordered.count()
    # one order for all runs: equal rows are neighbours
    return running(ordered, ["hilbert", *KEY, "_row"], F.lit(0), "shard-order"), total


def placed(order: DataFrame, total: int, n_shards: int) -> DataFrame:
    """Adds ``shard`` and ``slot``: runs whose row counts differ by one at most."""
    shard = F.expr(f"cast(_rank * {n_shards}L div {max(total, 1)}L as long)")
    # first rank of a shard: the smallest r with r * shards div total = shard
    slot = F.col("_rank") - F.expr(f"(_shard * {max(total, 1)}L + {n_shards - 1}L) div {n_shards}L")
    return order.withColumn("_shard", shard).withColumn("slot", slot).withColumn("shard", F.col("_shard").cast("int")).drop("_shard")


def shard_by_hilbert(docs: DataFrame, dims: list[str], n_shards: int, bits: int = 5) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert``: every row
    in curve order, cut into ``n_shards`` runs whose row counts differ by one at most.

    ``size`` is the text's UTF-8 bytes plus 8; a NULL text has none and checksum 0.
    Equal metadata is ordered by ``doc_id``, size and checksum; repeated rows take
    neighbouring slots. ``dims`` may name any columns, ``size`` among them. No text
    is moved, however long: only ids, sizes and curve positions are shuffled. An empty
    table gives no rows; other columns are left behind.
    """
    order, total = ranked(docs, dims, bits)
    return placed(order, total, n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert"
    )


def sharded_documents(docs: DataFrame, dims: list[str], n_shards: int, bits: int = 5) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` and ``slot``, in this order: each
    task holds a run of the curve, so the files written from it cover few values of
    each dimension. Columns of ``docs`` with these two names are replaced.

    Rows meet their places by key. Rows that are equal in all columns have neighbouring
    ranks, so they travel as one with a count, however many they are.
    """
    order, total = ranked(docs, dims, bits)
    places = order.groupBy(*KEY).agg(F.min("_rank").alias("low"), F.max("_rank").alias("high"))
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *keys(docs))
    same = [rows[k].eqNullSafe(places[k]) for k in KEY]
    held = rows.dropDuplicates(KEY).join(places, same).select("row", "low", "high")
    # counted out in two steps, so that no row has a list of all its copies
    steps = held.select("row", "high", F.explode(F.sequence("low", "high", F.lit(10_000).cast("long"))).alias("low"))
    each = steps.select("row", F.explode(F.sequence("low", F.least(F.col("low") + 9_999, F.col("high")))).alias("_rank"))
    out = placed(each, total, n_shards).select(*[F.col(f"row.`{c}`") for c in names], "shard", "slot")
    return out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")


@catalog.add()
def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 runs of a curve over source, language and size."""
    return shard_by_hilbert(documents(spark, sf_dir), ["source", "lang", "size"], 24)
