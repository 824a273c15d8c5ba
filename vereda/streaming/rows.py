"""Stateless operators on a streaming table.

The library has no stateful stream operator. Row expressions and joins to
static dictionaries work the same on a stream; this module names the ones that
are meant for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vereda.functions import text as tx
from vereda.operators.text import unpivot_segments


def clean_stream(stream: DataFrame, text: str) -> DataFrame:
    """Adds ``clean_text`` and ``text_length`` to each arriving row."""
    out = stream.withColumn("clean_text", tx.clean_text(F.col(text)))
    return out.withColumn("text_length", tx.text_length(F.col("clean_text")))


def segment_stream(stream: DataFrame, ids: list[str], parts: list[str]) -> DataFrame:
    """Non-blank parts of each arriving review as rows of their own."""
    return unpivot_segments(stream, ids, parts)
