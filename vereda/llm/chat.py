"""Chat formatting after collapsing cumulative snapshots, in DataFrame operations only.

A chat log often holds a conversation several times, each time some turns longer.
Rolling hashes of all turn prefixes tell which conversations are prefixes of longer
ones or equal to others; anti-joins keep the maximal ones, and these are rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from bindings.common import Catalog
from vereda.session import materialize

catalog = Catalog()

#: turns rendered into one part
PART = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, pos, h1, h2``: each distinct turn with its position
    from 1 and a 128-bit hash of all turns up to it.

    The hash of a prefix is the exclusive or of hashes of (position, turn), so it
    rolls along and can be put together from ranges: rows are placed by range of
    (conversation, turn), hashed inside each range, and continued from the ranges
    before. A conversation with a third of all turns is many ranges.
    """
    keys = ["conv_id", "turn", "digest"]
    placed = materialize(
        turns.select(*keys).distinct().repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "chat-ranges"
    )
    inside = W.partitionBy("part", "conv_id").orderBy("turn", "digest")
    rolling = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    # one row per range and conversation in it; only a conversation that spans ranges has several
    counts = placed.groupBy("part", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))).where("skip > 0").drop("n")
    at = _shifted(placed, counts, ["skip"]).withColumn("pos", F.row_number().over(inside).cast("long") + F.coalesce("skip", F.lit(0)))
    at = materialize(at.select(*keys, "part", "pos"), "chat-positions")
    for h, mark in (("h1", 1), ("h2", 2)):
        at = at.withColumn(h, F.xxhash64(F.lit(mark), "pos", "digest"))
    sums = at.groupBy("part", "conv_id").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    carry = sums.withColumns({b: F.coalesce(F.bit_xor(b).over(before), F.lit(0)) for b in ("b1", "b2")}).where("b1 != 0 or b2 != 0")
    out = _shifted(at, carry, ["b1", "b2"])
    return out.select(*keys, "pos", *[F.bit_xor(h).over(rolling).bitwiseXOR(F.coalesce(b, F.lit(0).cast("long"))).alias(h) for h, b in (("h1", "b1"), ("h2", "b2"))])


def _shifted(rows: DataFrame, shifts: DataFrame, names: list[str]) -> DataFrame:
    shifts = shifts.select(F.col("part").alias("_part"), F.col("conv_id").alias("_conv"), *names)
    return rows.join(shifts, (rows["part"] == shifts["_part"]) & rows["conv_id"].eqNullSafe(shifts["_conv"]), "left").drop("_part", "_conv")


def maximal(hashes: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies`` of the conversations to keep, from a stored
    table of prefix hashes: none that a longer one begins with, and of equal ones
    that with the smallest id."""
    top = hashes.groupBy("conv_id").agg(F.max("pos").alias("n_turns"))
    top = top.withColumnRenamed("conv_id", "_conv")
    last = hashes.join(top, hashes["conv_id"].eqNullSafe(top["_conv"]) & (hashes["pos"] == top["n_turns"])).select("conv_id", "n_turns", "h1", "h2")
    last = materialize(last, "chat-whole")
    ends = last.withColumnsRenamed({"conv_id": "_conv", "n_turns": "_n", "h1": "_h1", "h2": "_h2"})
    # prefixes shorter than their conversation, one row each
    inner = hashes.join(ends, hashes["conv_id"].eqNullSafe(ends["_conv"]) & (hashes["pos"] == ends["_n"]), "left_anti")
    inner = inner.select("pos", "h1", "h2").distinct()
    # NULL is the smallest id
    first = F.min(F.struct(F.col("conv_id").isNotNull().alias("some"), "conv_id"))
    whole = last.groupBy("n_turns", "h1", "h2").agg(first.alias("c"), F.count(F.lit(1)).alias("n_copies"))
    same = (whole["n_turns"] == inner["pos"]) & (whole["h1"] == inner["h1"]) & (whole["h2"] == inner["h2"])
    return whole.join(inner, same, "left_anti").select(F.col("c.conv_id").alias("conv_id"), "n_turns", "n_copies")


def collapse_and_render(conversations: DataFrame) -> DataFrame:
    """``conv_id, part, n_turns, n_copies, rendered``: the maximal conversations as
    chat markup, in parts of 256 turns.

    Turns are ordered by ``turn`` (NULL first), then by the SHA-256 of role and
    text; a turn repeated in full counts once; NULL roles and texts read as empty;
    turns without ``conv_id`` are one conversation. ``n_copies`` counts the equal
    conversations of which this is the first. An empty table gives no rows, and
    other columns are ignored.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = turns.withColumn("digest", F.sha2(F.concat_ws("\u0000", "role", "text"), 256))
    hashes = materialize(prefix_hashes(turns), "chat-hashes")
    kept = materialize(maximal(hashes), "chat-kept")
    parts = kept.select(F.col("conv_id").alias("_conv"), "n_turns", "n_copies", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_turns - 1) div {PART}L"))).alias("part"))
    places = hashes.withColumn("_part", F.expr(f"(pos - 1) div {PART}L"))
    places = places.join(parts, places["conv_id"].eqNullSafe(parts["_conv"]) & (places["_part"] == parts["part"]))
    places = places.select("_conv", F.col("turn").alias("_turn"), F.col("digest").alias("_digest"), "pos", "part", "n_turns", "n_copies")
    same = turns["conv_id"].eqNullSafe(places["_conv"]) & turns["turn"].eqNullSafe(places["_turn"]) & (turns["digest"] == places["_digest"])
    line = F.concat(F.lit(OPEN), "role", F.lit("\n"), "text", F.lit(CLOSE + "\n"))
    lines = turns.join(places, same).select("conv_id", "part", "n_turns", "n_copies", F.struct("pos", line.alias("line")).alias("at"))
    return lines.groupBy("conv_id", "part", "n_turns", "n_copies").agg(
        # a set, so that repeated rows merge before the shuffle; at most 256 turns
        F.concat_ws("", F.transform(F.array_sort(F.collect_set("at")), lambda a: a["line"])).alias("rendered")
    )


@catalog.add("""
with t as (
  select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, sha256(coalesce(role, '') || chr(0) || coalesce(text, '')) as digest from conversations),
p as (
  select *, row_number() over (partition by conv_id order by turn nulls first, digest) as pos from t),
c as (select conv_id, max(pos) as n, list(digest order by pos) as ds from p group by 1),
pre as (select conv_id, n, i, array_to_string(ds[1:i], ' ') as k from (select *, unnest(range(1, n + 1)) as i from c)),
whole as (select min(conv_id) as conv_id, n as n_turns, count(*) as n_copies, k from pre where i = n group by k, n),
kept as (select * from whole where k not in (select k from pre where i < n))
select kept.conv_id, (pos - 1) // 256 as part, n_turns, n_copies,
  string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by pos) as rendered
from kept join p using (conv_id) group by all
""")
def op1_collapsed_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All maximal conversations, rendered."""
    return collapse_and_render(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
