"""Helpers of the training-data operators: words, scratch tables, distributed running sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from vereda.session import materialize

#: a word: everything between ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
#: what separates words
SPACES = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def raw(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and the text's UTF-8 bytes, for tasks in Python; other columns are left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *more)


def n_words(text: Column) -> Column:
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running(df: DataFrame, keys: list[str], value: Column, label: str) -> DataFrame:
    """Adds ``_rank`` (from 0) and ``_before`` (sum of ``value`` over all earlier
    rows) in the total order of ``keys``, whatever the skew.

    Rows are placed by range, ranked inside each range and shifted by the totals
    of the ranges before it, so no task sees more than its range. ``keys`` must
    tell all rows apart and ``df`` must be a stored table (it is read twice).
    """
    placed = df.withColumn("_value", value.cast("long")).repartitionByRange(*keys)
    placed = materialize(placed.withColumn("_range", F.spark_partition_id()), label)
    totals = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.sum("_value").alias("_sum"))
    # one row per range: as many as the job has shuffle partitions
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shifts = totals.select(
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"),
    )
    inside = W.partitionBy("_range").orderBy(*keys)
    return (
        placed.withColumn("_rank", F.row_number().over(inside).cast("long") - 1)
        .withColumn("_before", F.coalesce(F.sum("_value").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .join(shifts, "_range")
        .withColumn("_rank", F.col("_rank") + F.col("_shift"))
        .withColumn("_before", F.col("_before") + F.col("_base"))
        .drop("_range", "_value", "_shift", "_base")
    )


def arrow_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def batch_of(names: list[str], rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=schema.field(n).type) for n, c in zip(names, columns, strict=True)], schema=schema
    )


def task_id() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words: a sum with an odd factor per place, mixed."""
    m = max(len(h) - n + 1, 0)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out += h[k : k + m] * np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1) ** 3 | 1) & 0xFFFFFFFFFFFFFFFF)
    return mixed(out)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    return space, mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


SPACE, BYTE_VALUES = _tables()
FACTOR = 0xD6E8FEB86659FD93
INVERSE = pow(FACTOR, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts`` in order, and the text of each word.

    A word's hash is the polynomial of its bytes' values at ``FACTOR``, taken from
    one running sum over all bytes, mixed with its length; equal words are equal
    wherever they stand.
    """
    line = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = SPACE[line]
    edges = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edges[::2], edges[1::2]
    terms = BYTE_VALUES[line] * powers(FACTOR, len(line))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    value = (sums[ends] - sums[starts]) * powers(INVERSE, len(line))[starts]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    owner = np.searchsorted(np.cumsum(lengths), starts, side="right")
    return mixed(value ^ mixed((ends - starts).astype(np.uint64))), owner


def slices(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``most`` bytes of ``text`` (or one longer text)."""
    for b in batches:
        sizes = [len(t) if t else 0 for t in (x.as_buffer() if x.is_valid else None for x in b.column("text"))]
        start, size = 0, 0
        for i, n in enumerate(sizes):
            if i > start and size + n > most:
                yield b.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < b.num_rows:
            yield b.slice(start)


def stretches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of rows that are sorted by ``keys``, each whole."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        codes = np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in keys])
        heads = np.flatnonzero((np.diff(codes, axis=1) != 0).any(0)) + 1
        for a, z in zip([0, *heads.tolist()], [*heads.tolist(), b.num_rows], strict=True):
            key = tuple(codes[:, a])
            if last is not None and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(a, z - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)
