"""Mixing sources to target weights, in DataFrame operations only.

Each source's words form one stream, cut into blocks of a fixed length. A source has
a quota of slots, which keeps it near its target and below its cap; how many of them
each output shard gets is a multinomial draw for the quota. A shard's slots are the
next ones by these counts. Slot numbers map to block numbers through a keyed
permutation per source and pass, and blocks are joined by number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bindings.common import Catalog
from vereda.llm.common import SPACES, documents, n_words, running
from vereda.session import materialize

catalog = Catalog()

#: words in a block
BLOCK = 64
#: rounds of the permutation
ROUNDS = 24


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n-1 for any n: the swap-or-not shuffle
    of Hoang, Morris and Rogaway (2012), keyed by ``key``."""

    def step(acc, r):
        partner = F.pmod(F.pmod(F.xxhash64(F.lit("k"), r, *key), n) - acc + n, n)
        swap = F.xxhash64(F.lit("f"), r, F.greatest(acc, partner), *key).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, partner).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, step)


def source_targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Adds ``target`` to a stored table (source, source_size, _rank, _before).

    The sources, ranked by code point with NULL last, take ``weights`` in turn and
    share ``share`` times all sizes. A target stops at ``most`` times its source's
    size and the excess goes to the others by weight, again until none is above.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, 0
    while True:  # each pass caps a further source or ends; two sums come back per pass
        above = F.lit(False) if level is None else weight * F.lit(level) > cap
        w, c, n = sizes.agg(F.sum(F.when(~above, weight)), F.sum(F.when(above, cap)), F.count(F.when(above, 1))).first()
        if level is not None and n == capped or not w:
            break
        level, capped = (total * share - (c or 0.0)) / w, n
    level = level if level is not None else 0.0
    return sizes.withColumn("target", F.least(weight * F.lit(level), cap))


class Mix:
    """The tables of one mix. ``docs`` may be any table with ``doc_id``, ``source``
    and ``text``; NULL text has no words, a NULL source is a source, repeated rows
    are separate documents, an empty table gives an empty mix. A very long text is
    a piece of each block that it reaches into; other columns are left behind."""

    def __init__(self, docs: DataFrame, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0, n_shards=24, block=BLOCK, seed=10):
        self.block, self.n_shards, self.seed, self._ends = block, n_shards, seed, None
        base = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            n_words(F.col("text")).alias("size"), F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("crc"),
            F.monotonically_increasing_id().alias("_row"),
        ).withColumn("last", F.col("source").isNull())
        # the stream's order is by hash, so that a block mixes documents
        base = base.withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "crc"))
        base = materialize(base, "mix-sizes")
        sizes = materialize(base.groupBy("last", "source").agg(F.sum("size").alias("source_size")), "mix-sources")
        sizes = materialize(running(sizes, ["last", "source"], F.col("source_size"), "mix-source-order"), "mix-ranks")
        sizes = source_targets(sizes, list(weights), share, most)
        words, n_blocks = F.col("source_size"), F.ceil(F.col("source_size") / block).cast("long")
        passes = F.when(words > 0, F.floor(F.col("target") / words)).otherwise(0).cast("long")
        part = F.least(F.round((F.col("target") - passes * words) / block).cast("long"), n_blocks)
        self.sources = materialize(
            sizes.withColumn("n_blocks", n_blocks).withColumn("slots", passes * n_blocks + part)
            .withColumnRenamed("_rank", "source_no").withColumnRenamed("_before", "source_start"),
            "mix-targets",
        )
        order = ["last", "source", "key", "doc_id", "crc", "_row"]
        placed = running(base, order, F.col("size"), "mix-order").drop("_rank")
        s = self.sources.withColumnsRenamed({"source": "_source", "last": "_last"})
        placed = placed.join(s, placed["source"].eqNullSafe(s["_source"]) & (placed["last"] == s["_last"])).drop("_source", "_last")
        self.placed = materialize(placed.withColumn("start", F.col("_before") - F.col("source_start")), "mix-places")

    def pieces(self) -> DataFrame:
        """One row per block that a document reaches into; none for a document without words."""
        first, last = F.expr(f"start div {self.block}L"), F.expr(f"(start + size - 1) div {self.block}L")
        return (
            self.placed.where("size > 0")
            .select("_row", "source_no", "n_blocks", "slots", "start", "size", F.explode(F.sequence(first, last)).alias("block_no"))
            .withColumn("from", F.greatest(F.col("block_no") * self.block, F.col("start")) - F.col("start"))
            .withColumn("upto", F.least((F.col("block_no") + 1) * self.block, F.col("start") + F.col("size")) - F.col("start"))
        )

    def numbers(self) -> DataFrame:
        """``source_no, n_blocks, slot, pass_no``: every slot once. A source's slots come from
        its blocks' own numbers, so that a source with a third of all words is spread."""
        own = self.pieces().where((F.col("start") + F.col("from")) % self.block == 0)
        passes = F.expr("(slots - block_no - 1 + n_blocks) div n_blocks")  # slots block_no, block_no + n_blocks, ...
        each = own.where("block_no < slots").select(
            "source_no", "n_blocks", "block_no", F.explode(F.sequence(F.lit(0).cast("long"), passes - 1)).alias("pass_no")
        )
        return each.select("source_no", "n_blocks", (F.col("pass_no") * F.col("n_blocks") + F.col("block_no")).alias("slot"), "pass_no")

    def shard_counts(self) -> DataFrame:
        """``source_no, counts``: how many of a source's slots each shard gets, a multinomial
        draw: one uniform draw for each slot, counted."""
        drawn = F.pmod(F.xxhash64(F.lit("shard"), F.lit(self.seed), "source_no", "slot"), F.lit(self.n_shards))
        tallies = [F.count_if(drawn == k) for k in range(self.n_shards)]
        return self.numbers().groupBy("source_no").agg(F.array(*tallies).alias("counts"))

    def slots(self) -> DataFrame:
        """``source_no, slot, shard, pass_no, block_no``: all draws. Shard 0 has a source's first
        slots, as many as its count, shard 1 the next ones, and so on."""
        if self._ends is None:
            # one row a source with a number a shard
            ends = F.transform("counts", lambda c, i: F.aggregate(F.slice("counts", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, x: a + x))
            self._ends = materialize(self.shard_counts().select("source_no", ends.alias("ends")), "mix-shards")
        inside = F.col("slot") % F.col("n_blocks")
        return self.numbers().join(self._ends, "source_no").select(
            "source_no", "slot", F.size(F.filter("ends", lambda e: e <= F.col("slot"))).alias("shard"), "pass_no",
            permuted(inside, F.col("n_blocks"), F.lit(self.seed), F.col("source_no"), F.col("pass_no")).alias("block_no"),
        )

    def draws(self) -> DataFrame:
        """Pieces with ``draws``, the number of times their block is taken, and its ``shards``."""
        draws = self.slots().groupBy("source_no", "block_no").agg(F.count(F.lit(1)).alias("draws"), F.collect_set("shard").alias("shards"))
        return self.pieces().join(draws, ["source_no", "block_no"])

    def taken(self) -> DataFrame:
        """``doc_id, size, source_size, target, taken, shards`` and ``_row`` for every
        document; ``shards`` are those that get words of it, in order."""
        # at most one set of shards for each block of a document
        got = self.draws().groupBy("_row").agg(
            F.sum((F.col("upto") - F.col("from")) * F.col("draws")).alias("taken"),
            *[F.max(F.array_contains("shards", k)).alias(f"in_{k}") for k in range(self.n_shards)],
        )
        shards = F.filter(F.array(*[F.when(F.col(f"in_{k}"), k) for k in range(self.n_shards)]), lambda k: k.isNotNull())
        return self.placed.join(got, "_row", "left").select(
            "_row", "doc_id", "crc", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), shards.alias("shards")
        )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the texts that the mix takes, under the same columns.

    A text becomes its taken words, joined by one space: whole passes first, then
    the drawn pieces of the last pass in order. Documents of which nothing is taken
    go; a text taken once as a whole stays as it is. ``n_chars``, where present,
    is counted anew. Rows repeated in full have one mix and stay repeated.
    """
    mix = Mix(docs, **options)
    drawn = mix.draws().groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("from", "upto", "draws"))).alias("_pieces")
    )
    plan = mix.placed.join(drawn, "_row").groupBy("doc_id", "source", "size", "crc").agg(F.min_by("_pieces", "_row").alias("_pieces"))
    # the caller's columns are nested, so that no name clashes
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("row_crc"))
    joined = keyed.join(
        plan,
        F.col("row.doc_id").cast("long").eqNullSafe(plan["doc_id"]) & (F.col("row_crc") == plan["crc"]) & F.col("row.source").cast("string").eqNullSafe(plan["source"]),
    )
    text_in = F.col("row.text")
    words = F.filter(F.split(text_in, SPACES), lambda w: w != "")
    most = F.array_max(F.transform("_pieces", lambda p: p["draws"]))
    least = F.when(F.aggregate("_pieces", F.lit(0).cast("long"), lambda a, p: a + p["upto"] - p["from"]) == F.col("size"), F.array_min(F.transform("_pieces", lambda p: p["draws"]))).otherwise(0)

    def text_of(w):
        passes = F.transform(
            F.sequence(F.lit(1).cast("long"), most),
            lambda k: F.flatten(F.transform(F.filter("_pieces", lambda p: p["draws"] >= k), lambda p: F.slice(w, (p["from"] + 1).cast("int"), (p["upto"] - p["from"]).cast("int")))),
        )
        return F.array_join(F.flatten(passes), " ")

    text = F.when((least == 1) & (most == 1), text_in).otherwise(F.get(F.transform(F.array(words), text_of), F.lit(0)))
    new = {"text": F.col("new_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("new_text").cast(docs.schema["n_chars"].dataType)
    out = joined.select("row", text.alias("new_text"))
    return out.select(*[new[n].alias(n) if n in new else F.col(f"row.`{n}`") for n in docs.columns])


@catalog.add()
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 3, 1, 2 in turn over the sources, 150 % of all words, at most twice each."""
    return Mix(documents(spark, sf_dir)).taken().drop("_row", "crc")
