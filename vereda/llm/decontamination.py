"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages, and a randomised SVD of the TF-IDF table of
these and all corpus passages, over the items' words, gives the latent space, completed
where it misses an item's passage. The corpus passages enter as a sparse embedding of
their table (Clarkson and Woodruff, 2013): each is added to or taken from one of
``SKETCH`` rows, which keep the table's product with its transpose. Windows of every document
are compared with every passage by cosine, and what may be a copy or paraphrase is
checked by the longest common subsequence of words and by the item's longest words
(its answer). The answer comes from the item alone, so no leak can move it.

A window's product with a passage is the sum of its words' products, so the tasks
hold those, a sparse table, and not the space itself.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from bindings.common import Catalog
from vereda.llm.common import documents, mixed, n_words, raw, slices
from vereda.session import materialize

catalog = Catalog()

#: passages of items in a block, and blocks in a pass over the documents; rows that the documents' passages are
#: summed to for the fit, sums that a task holds, and the passages' squared weight as a share of the items'
#: passages'; dimensions of the space, which grow with the block's passages up to RANK
BLOCK_PASSAGES, PASS_BLOCKS, SKETCH, HELD_SUMS, FIT_SHARE, RANK, EXTRA = 400, 32, 1024, 1 << 19, 0.06, 512, 8
#: rows of the table that are multiplied at once
ROWS_AT_ONCE = 128
#: share of a passage's squared weight that the space holds at least
HELD = 0.5
#: words of an item's passage and of a step; steps in a window, and steps handled at once
PASSAGE, STEP, SPAN, AT_ONCE = 48, 16, 5, 1024
#: share of a passage's weight that a window must hold to be checked; products below this part of it are left
#: out, and the limit is lowered by as much as a window's words could lose
CANDIDATE, LEAST_PART = 0.5, 2e-4
#: share of an item's words in order that makes a leak, and the one that does with half of its longest words
SURE, COMMON, ANSWER, LONGEST = 0.75, 0.6, 0.5, 4

#: ASCII punctuation and control characters read as spaces
PLAIN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Words, A-Z in lower case, cut at ASCII punctuation as well as at white space."""
    return (text or b"").lower().translate(PLAIN).split()


def inverse_frequencies(docs: DataFrame, vocabularies: list[list[bytes]]) -> list[np.ndarray]:
    """Smoothed inverse document frequencies over all documents, in one pass for all
    vocabularies. All are above 0: an item in most documents has only common terms."""
    terms = sorted({t for v in vocabularies for t in v})
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def run(batches):
        place = shared.value
        counts, n = np.zeros(len(place), np.int64), 0
        for b in batches:
            for t in b.column("text").to_pylist():
                found = place.keys() & set(terms_of(t))
                counts[[place[w] for w in found]] += 1
                n += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"term": np.append(at, -1), "n": np.append(counts[at], n)})

    got = raw(docs).select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts, total = np.zeros(len(terms)), 0
    for t, n in got:
        if t < 0:
            total = n
        else:
            counts[t] = n
    shared.unpersist()
    idf = np.log((1 + total) / (1 + counts)) + 0.05
    place = {t: i for i, t in enumerate(terms)}
    return [idf[[place[t] for t in v]] for v in vocabularies]


def passages_of(terms: list[bytes], size: int = PASSAGE) -> list[list[bytes]]:
    """Parts of at most ``size`` words and nearly equal length."""
    n = max(1, -(-len(terms) // size))
    edges = [round(i * len(terms) / n) for i in range(n + 1)]
    return [terms[a:b] for a, b in zip(edges, edges[1:], strict=False) if b > a]


def weighted_passages(texts: list[bytes | None], place: dict[bytes, int], idf: np.ndarray) -> tuple[np.ndarray, ...]:
    """Term, TF-IDF weight and passage of every different term of the passages of ``texts``, whose
    rows have unit length; then the text of each passage and its number there."""
    words = [terms_of(t) for t in texts]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    parts = np.ceil(lengths / PASSAGE).astype(np.int64)
    text = np.repeat(np.arange(len(words)), parts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    # the same edges as in passages_of
    ends = np.rint((number + 1) * lengths[text] / parts[text]).astype(np.int64)
    passage = np.repeat(np.arange(len(text)), np.diff(ends, prepend=0) + np.where(number == 0, np.r_[0, ends][:-1], 0))
    term = np.fromiter(map(place.get, (w for x in words for w in x), repeat(-1)), np.int64, len(passage))
    known = term >= 0
    keys, n = np.unique(passage[known] * len(place) + term[known], return_counts=True)
    passage, term = np.divmod(keys, max(len(place), 1))
    x = n * idf[term]
    return term, x / np.sqrt(np.bincount(passage, weights=x * x, minlength=len(text)))[passage], passage, text, number


def passage_sums(docs: DataFrame, terms: list[bytes], idf: np.ndarray) -> DataFrame:
    """``bucket, terms, parts``: the unit TF-IDF rows over ``terms`` of all passages of all documents,
    each with a random sign in one of ``SKETCH`` sums (packed term numbers and sums)."""
    shared = docs.sparkSession.sparkContext.broadcast(({t: i for i, t in enumerate(terms)}, idf))
    names = ["bucket", "terms", "parts"]

    def packed(keys: np.ndarray, sums: np.ndarray, n_terms: int) -> pa.RecordBatch:
        bucket = keys // n_terms
        heads = np.flatnonzero(np.diff(bucket, prepend=-1))
        edges = list(zip(heads.tolist(), [*heads[1:].tolist(), len(keys)], strict=True)) if len(keys) else []
        term, sums = (keys % n_terms).astype(np.int32), sums.astype(np.float32)
        return pa.RecordBatch.from_arrays([
            pa.array(bucket[heads], pa.int64()), pa.array([term[a:z].tobytes() for a, z in edges], pa.binary()),
            pa.array([sums[a:z].tobytes() for a, z in edges], pa.binary()),
        ], names=names)

    def run(batches):
        place, idf = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed():
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(at, weights=np.concatenate([v for _, v in held]), minlength=len(keys))

        for b in slices(batches):
            texts = b.column("text").to_pylist()
            term, x, passage, text, number = weighted_passages(texts, place, idf)
            ids = b.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            seeds = mixed(ids) ^ np.fromiter((zlib.crc32(t or b"") for t in texts), np.uint64, len(texts))
            draw = mixed(mixed(seeds[text]) + number.astype(np.uint64))
            bucket, sign = (draw >> np.uint64(1)) % np.uint64(SKETCH), 1.0 - 2.0 * (draw & np.uint64(1))
            held.append((bucket.astype(np.int64)[passage] * len(place) + term, x * sign[passage]))
            if sum(len(k) for k, _ in held) > HELD_SUMS:
                held[:] = [summed()]
                if len(held[0][0]) > HELD_SUMS // 2:
                    yield packed(*held.pop(), len(place))
        if held:
            yield packed(*summed(), len(place))

    def add(batches):
        held, total, n_terms = None, None, len(shared.value[0])
        for b in batches:
            for bucket, t, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if bucket != held:
                    if held is not None:
                        at = np.flatnonzero(total)
                        yield packed(held * n_terms + at, total[at], n_terms)
                    held, total = bucket, np.zeros(n_terms)
                total[np.frombuffer(t, np.int32)] += np.frombuffer(x, np.float32)
        if held is not None:
            at = np.flatnonzero(total)
            yield packed(held * n_terms + at, total[at], n_terms)

    schema = "bucket long, terms binary, parts binary"
    sums = raw(docs).mapInArrow(run, schema).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add, schema)
    sums = materialize(sums, "leak-passages")
    shared.unpersist()
    return sums


def latent_space(rows: DataFrame, n_terms: int, rank: int, turns: int = 1) -> np.ndarray:
    """Right singular vectors (terms x rank) of the table with the given rows (packed
    term numbers ``terms`` and values ``parts``), by a randomised range finder (Halko, Martinsson and Tropp, 2011).

    Each pass multiplies the table by its transpose inside the tasks; the tasks'
    products are summed term by term by Spark. The driver holds the block's terms,
    at most BLOCK_PASSAGES * PASSAGE, with RANK + EXTRA single-precision numbers each.
    """
    spark = rows.sparkSession
    width = rank + EXTRA
    basis = np.random.default_rng(8).standard_normal((n_terms, width), np.float32)

    def product(q: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(q)

        def run(batches):
            out, seen = np.zeros_like(shared.value), np.zeros(n_terms, bool)
            for b in batches:
                rows = [(np.frombuffer(t, np.int32), np.frombuffer(x, np.float32)) for t, x in zip(b.column("terms").to_pylist(), b.column("parts").to_pylist(), strict=True)]
                for low in range(0, len(rows), ROWS_AT_ONCE):
                    some = rows[low : low + ROWS_AT_ONCE]
                    ids, at = np.unique(np.concatenate([t for t, _ in some]), return_inverse=True)
                    table = np.zeros((len(some), len(ids)), np.float32)
                    table[np.repeat(np.arange(len(some)), [len(t) for t, _ in some]), at] = np.concatenate([x for _, x in some])
                    out[ids] += table.T @ (table @ shared.value[ids])
                    seen[ids] = True
            at = np.flatnonzero(seen)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([v.tobytes() for v in out[at]], pa.binary())], names=["term", "part"])

        def add(batches):
            out: dict[int, np.ndarray] = {}
            for b in batches:
                for i, v in zip(b.column("term").to_pylist(), b.column("part").to_pylist(), strict=True):
                    out[i] = out.get(i, np.float32(0)) + np.frombuffer(v, np.float32)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(out)), pa.array([v.tobytes() for v in out.values()], pa.binary())], names=["term", "part"])

        schema = "term long, part binary"
        sums = materialize(rows.mapInArrow(run, schema).repartition("term").mapInArrow(add, schema), "leak-sums")
        total = np.zeros_like(q)
        for r in sums.toLocalIterator():
            total[r["term"]] = np.frombuffer(r["part"], np.float32)
        shared.unpersist()
        return total

    for _ in range(turns + 1):
        basis = np.linalg.qr(product(basis))[0]
    square = (basis.T @ product(basis)).astype(np.float64)
    values, vectors = np.linalg.eigh((square + square.T) / 2)
    keep = np.argsort(-values)[:rank]
    return basis @ vectors[:, keep[values[keep] > 1e-7]].astype(np.float32)


def completed(space: np.ndarray, passages: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """``space`` with a direction more for what it lacks of each passage (term numbers)
    of which it holds less than ``HELD``, so that every passage has a vector."""
    for ids in passages:
        ids, n = np.unique(ids, return_counts=True)
        x = n * idf[ids]
        x = x / np.linalg.norm(x)
        held = x @ space[ids]
        if held @ held < HELD:
            rest = -(space @ held)
            rest[ids] += x
            rest -= space @ (space.T @ rest)
            space = np.column_stack([space, rest / np.linalg.norm(rest)])
    return space


class Space:
    """Everything a task needs to look for the items of one block: per term its product
    with each passage, in parts of the passage's limit."""

    def __init__(self, items: list[tuple[int, list[bytes]]], terms: list[bytes], idf: np.ndarray, space: np.ndarray):
        self.items = items
        loads = (space * idf[:, None]).astype(np.float32)
        place = {t: i for i, t in enumerate(terms)}
        self.passage_item, vectors = [], []
        for k, (_, words) in enumerate(items):
            for p in passages_of(words):
                v = loads[[place[w] for w in p]].sum(0)
                if v @ v > 0:
                    self.passage_item.append(k)
                    vectors.append(v)
        passages = np.array(vectors, np.float32).reshape(len(vectors), loads.shape[1])
        # cosine >= share * |passage| / |window|: the window holds that share of the passage
        parts = loads @ passages.T / (CANDIDATE * (passages**2).sum(1))
        row, columns = np.nonzero(np.abs(parts) > LEAST_PART)
        self.columns, self.values = columns.astype(np.int32), parts[row, columns]
        live, counts = np.unique(row, return_counts=True)
        self.row = {terms[t]: i for i, t in enumerate(live.tolist())}
        self.heads = np.cumsum(counts) - counts
        self.counts = counts
        self.answers = [set(sorted(set(words), key=lambda w: (-len(w), w))[:LONGEST]) for _, words in items]

    def candidates(self, words: list[list[bytes]], first: np.ndarray) -> Iterator[tuple[int, int]]:
        """(step, item) of windows that may hold the item."""
        n_passages, limit = len(self.passage_item), 1 - LEAST_PART * STEP * SPAN
        row = np.fromiter(map(self.row.get, (w for x in words for w in x), repeat(-1)), np.int64, sum(map(len, words)))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        start = np.repeat(first[:-1] * STEP - (np.cumsum(lengths) - lengths), lengths)
        owner = (np.arange(len(row)) + start) // STEP
        known = row >= 0
        row, owner = row[known], owner[known]
        steps = int(first[-1])
        last = np.repeat(first[1:], np.diff(first))
        for low in range(0, steps, AT_ONCE):
            high = min(low + AT_ONCE, steps)
            top = min(high + SPAN, steps)
            a, z = np.searchsorted(owner, [low, top])
            r, o = row[a:z], owner[a:z] - low
            n = self.counts[r]
            at = np.repeat(self.heads[r] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            cell = np.repeat(o, n) * n_passages + self.columns[at]
            sums = np.bincount(cell, weights=self.values[at], minlength=(top - low) * n_passages).reshape(top - low, n_passages)
            sums = np.concatenate([np.zeros((1, n_passages)), np.cumsum(sums, axis=0)])
            begin = np.arange(low, high)
            end = np.minimum(begin + SPAN, last[begin])
            for s, p in zip(*np.nonzero(sums[end - low] - sums[begin - low] >= limit), strict=True):
                yield low + int(s), self.passage_item[p]

    def leaks(self, words: list[list[bytes]]) -> list[dict[int, float]]:
        """Per text (its terms) the places of the leaked items and the share of their words found in order."""
        out: list[dict[int, float]] = [{} for _ in words]
        first = np.cumsum([0] + [-(-len(w) // STEP) for w in words])
        if not self.passage_item or not first[-1]:
            return out
        text_of = np.repeat(np.arange(len(words)), np.diff(first))
        for s, k in dict.fromkeys(self.candidates(words, first)):
            d = int(text_of[s])
            if out[d].get(k, 0.0) >= 1.0:
                continue
            n = len(self.items[k][1])
            a = max(0, (s - int(first[d])) * STEP - n)
            share = self.check(k, words[d][a : (s - int(first[d]) + SPAN) * STEP + n])
            if share:
                out[d][k] = max(share, out[d].get(k, 0.0))
        return out

    def check(self, k: int, window: list[bytes]) -> float:
        """Share of the item's words that stand in the window in the same order; 0
        below the limits."""
        terms = self.items[k][1]
        if sum((Counter(terms) & Counter(window)).values()) < COMMON * len(terms):
            return 0.0
        share = common_subsequence(terms, window) / len(terms)
        answered = len(self.answers[k] & set(window)) >= ANSWER * len(self.answers[k])
        return share if share >= SURE or share >= COMMON and answered else 0.0


def found_in(spaces: list[Space], texts: list[bytes | None]) -> list[dict[int | None, float]]:
    """Per text the ids of its leaked items with the share; of items with one id the largest."""
    words = [terms_of(t) for t in texts]
    out: list[dict[int | None, float]] = [{} for _ in texts]
    for space in spaces:
        for mine, found in zip(out, space.leaks(words), strict=True):
            for k, share in found.items():
                i = space.items[k][0]
                mine[i] = max(share, mine.get(i, 0.0))
    return out


def common_subsequence(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, by bits (Hyyro, 2004)."""
    masks: dict[bytes, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & masks.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def spaces(docs: DataFrame, benchmark: DataFrame) -> Iterator:
    """Broadcast lists of search spaces, each for one pass over the documents. Items
    without words are left out; a NULL item id is kept as it is."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    passages = items.agg(F.sum(F.greatest(F.lit(1), F.ceil(n_words(F.col("text").cast("string")) / PASSAGE)))).first()[0] or 0
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-passages // BLOCK_PASSAGES)))).cast("int")
    items = materialize(items.withColumn("block", block), "leak-items")
    blocks = [r[0] for r in items.select("block").distinct().orderBy("block").collect()]
    for i in range(0, len(blocks), PASS_BLOCKS):
        some = blocks[i : i + PASS_BLOCKS]
        held: dict[int, list] = {}
        for r in items.where(F.col("block").isin(some)).collect():
            words = terms_of(bytes(r["text"] or b""))
            if words:
                held.setdefault(r["block"], []).append((r["item_id"], words))
        mine = [sorted(held[k], key=lambda r: (r[0] is None, r[0] or 0, r[1])) for k in some if k in held]
        vocabularies = [sorted({w for _, words in m for w in words}) for m in mine]
        if not mine:
            yield spark.sparkContext.broadcast([])
            continue
        # the blocks of a pass share one fit table of the documents, over all their terms
        every = sorted(set().union(*vocabularies))
        (idf,) = inverse_frequencies(docs, [every])
        sums = passage_sums(docs, every, idf)
        place = {t: i for i, t in enumerate(every)}
        at = [np.array([place[t] for t in v], np.int64) for v in vocabularies]
        yield spark.sparkContext.broadcast([
            Space(m, terms, idf[k], block_space(sums, m, terms, k, idf)) for m, terms, k in zip(mine, vocabularies, at, strict=True)
        ])


def block_space(sums: DataFrame, mine: list[tuple[int, list[bytes]]], terms: list[bytes], at: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The latent space of a block: its items' passages and those of all documents, over the
    items' terms, which are ``at`` these places of the pass's ``idf``."""
    spark = sums.sparkSession
    own, place = idf[at], {t: i for i, t in enumerate(terms)}
    shared = spark.sparkContext.broadcast(at)

    def restricted(batches):
        number = np.full(len(idf), -1, np.int32)
        number[shared.value] = np.arange(len(shared.value), dtype=np.int32)
        for b in batches:
            out: list[tuple[bytes, bytes, float]] = []
            for t, x in zip(b.column("terms").to_pylist(), b.column("parts").to_pylist(), strict=True):
                t, x = number[np.frombuffer(t, np.int32)], np.frombuffer(x, np.float32)
                t, x = t[t >= 0], x[t >= 0]
                if len(t):
                    out.append((t.tobytes(), x.tobytes(), float(x @ x)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.float64())], names=["terms", "parts", "square"])

    corpus = materialize(sums.mapInArrow(restricted, "terms binary, parts binary, square double"), "leak-rows")
    parts = [np.array([place[w] for w in p], np.int64) for _, words in mine for p in passages_of(words)]
    rows = []
    # at most BLOCK_PASSAGES rows, or those of one long item
    for p in parts:
        ids, n = np.unique(p, return_counts=True)
        x = n * own[ids]
        rows.append((ids.astype(np.int32).tobytes(), (x / np.linalg.norm(x)).astype(np.float32).tobytes()))
    total = corpus.agg(F.sum("square")).first()[0] or 1.0
    scale = np.float32(np.sqrt(FIT_SHARE * len(parts) / total))

    def scaled(batches):
        for b in batches:
            x = [(np.frombuffer(v, np.float32) * scale).tobytes() for v in b.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("terms"), pa.array(x, pa.binary())], names=["terms", "parts"])

    schema = "terms binary, parts binary"
    table = spark.createDataFrame(rows, schema).unionByName(corpus.select("terms", "parts").mapInArrow(scaled, schema))
    table = materialize(table, "leak-table")
    shared.unpersist()
    return completed(latent_space(table, len(terms), min(RANK, len(parts) + EXTRA)), parts, own)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, share``: every document with every item that leaks into it.

    ``share`` is the part of the item's words that the document has in order. NULL
    and blank texts leak nothing; rows are judged one by one, repeated ones and rows
    without an id too; items with one id count as one; an empty benchmark or table gives
    no rows. Of several windows with an item the largest share counts. Texts count
    whole: a task holds 1 MB of text at once, or one longer text with its words. Other
    columns are left behind. ``BLOCK_PASSAGES * PASS_BLOCKS`` passages of items share
    one pass for frequencies and one for the search; each pass' rows are stored.
    """
    out = None
    for space in spaces(docs, benchmark):

        def run(batches, space=space):
            for b in slices(batches):
                got = found_in(space.value, b.column("text").to_pylist())
                rows = [(d, i, s) for d, found in zip(b.column("doc_id").to_pylist(), got, strict=True) for i, s in found.items()]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64())], names=["doc_id", "item_id", "share"])

        part = materialize(raw(docs).mapInArrow(run, "doc_id long, item_id long, share double"), "leaks")
        space.unpersist()
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], "doc_id long, item_id long, share double")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows into which no item leaks, with all their columns, whatever their names."""
    at = docs.columns.index("text")
    schema = docs.schema
    for space in spaces(docs, benchmark):

        def run(batches, space=space):
            for batch in batches:
                texts = pa.RecordBatch.from_arrays([pc.cast(batch.column(at), pa.binary())], names=["text"])
                keep = [not found for b in slices([texts]) for found in found_in(space.value, b.column("text").to_pylist())]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs


@catalog.add()
def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the whole benchmark."""
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
