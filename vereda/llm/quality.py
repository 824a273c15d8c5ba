"""Quality rules: an n-gram model with modified Kneser-Ney smoothing and, per
language, a band of perplexities outside which a document is rejected.

Symbols are the UTF-8 bytes, each for itself, or (the operator's default) in 64 fixed
classes, of which a model of order 4 has at most 64 ** 4 n-grams whatever the corpus
holds. Of bytes it has as many as the corpus has different sequences of 4 bytes, which
new texts of the same scripts hardly add to. A task counts in sorted arrays of bounded
size. All texts are counted; counts, discounts, probabilities and back-off weights are
Spark aggregates and joins; the finished model is sorted arrays of 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bindings.common import Catalog
from vereda.llm.common import documents, gram_hashes, hashed_words, mixed, raw, slices
from vereda.session import materialize

catalog = Catalog()

#: n-gram order (2 to 4); bits of a class
ORDER, BITS = 4, 6
#: words of a window that counts as repeated; limits of the base rules
WINDOW, LEAST_WORDS, REPEATED_PERCENT = 8, 20, 30
#: half width of a band in robust deviations; step of the histogram of log10 perplexities;
#: documents' worth of weight of all languages in the band of one; least deviation in steps
WIDTH, STEP, POOLED, LEAST_STEPS = 6.0, 0.001, 30, 5.0
#: characters counted as symbols by the base
MARKS = b"#*$%&|<>"


def _classes() -> np.ndarray:
    """Class of every byte; 0 is kept for the edge of a text."""
    marks = [b".", b",", b"'\"", b"-_", b"!?", b":;", b"()[]{}", b"/\\", b"@", MARKS]
    leads = (0xC4, 0xCA, 0xD0, 0xD4, 0xDA, 0xE0, 0xE3, 0xE4, 0xEA, 0xF0)
    out = np.empty(256, np.uint32)
    for b in range(256):
        if b >= 0xC0:
            out[b] = 43 + sum(b >= x for x in leads)
        elif b >= 0x80:
            out[b] = 54 + (b & 0x3F) * 10 // 64
        elif chr(b).islower():
            out[b] = 1 + b - ord("a")
        elif chr(b).isupper():
            out[b] = 27
        elif chr(b).isdigit():
            out[b] = 31
        elif b == 0x20:
            out[b] = 28
        elif b in b"\r\n":
            out[b] = 29
        elif b < 0x20 or b == 0x7F:
            out[b] = 30
        else:
            out[b] = next((32 + i for i, m in enumerate(marks) if b in m), 42)
    return out


@dataclass(frozen=True)
class Alphabet:
    """The symbol of every byte, from 1, and the bits of a symbol; 0 is the edge of a text."""

    symbols: np.ndarray
    bits: int


CLASSES = _classes()
CLASSED = Alphabet(CLASSES, BITS)
#: every byte its own symbol; 0xFE and 0xFF, which UTF-8 never has, share one
BYTES = Alphabet(np.minimum(np.arange(1, 257), 255).astype(np.uint32), 8)
#: n-grams that a task holds before it merges or gives out its counts
HELD = 1 << 22
IS_MARK = np.isin(np.arange(256), list(MARKS))
#: bytes that begin a character and are no white space
COUNTED = np.array([(b & 0xC0) != 0x80 and b not in b" \t\n\v\f\r" for b in range(256)])


def grams(texts: list[bytes], order: int = ORDER, alphabet: Alphabet = CLASSED) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends in each byte of each text and in the text's end, as a
    number of ``order`` symbols, and the text of each. Texts begin with edges."""
    gap = bytes(order - 1)
    line = np.frombuffer(gap + b"".join(t + gap for t in texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + order - 1)
    codes = alphabet.symbols[line]
    event = np.ones(len(line), bool)
    event[: order - 1] = False
    for k in range(order - 1):
        codes[ends + k] = 0
        event[ends + k] = k == 0
    codes[: order - 1] = 0
    out = np.zeros(len(line) - order + 1, np.uint32)
    for k in range(order):
        out = (out << np.uint32(alphabet.bits)) | codes[k : k + len(out)]
    return out[event[order - 1 :]], np.repeat(np.arange(len(texts)), lengths + 1)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of counts of equal n-grams, in order."""
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], np.concatenate([n for _, n in parts])[order]
    heads = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint32(1)))
    return keys[heads], np.add.reduceat(counts, heads)


def gram_counts(docs: DataFrame, order: int = ORDER, alphabet: Alphabet = CLASSED) -> DataFrame:
    """``gram, n`` over all texts: a task gives a row for each of its n-grams, or several
    if it has more than ``HELD``."""

    def rows(keys, counts):
        for i in range(0, len(keys), 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + (1 << 20)].astype(np.int64)), pa.array(counts[i : i + (1 << 20)])], names=["gram", "n"])

    def run(batches):
        held: list = []
        for b in slices(batches):
            held.append(np.unique(grams([t or b"" for t in b.column("text").to_pylist()], order, alphabet)[0], return_counts=True))
            if sum(len(k) for k, _ in held) > HELD:
                held = [merged(held)]
                if 2 * len(held[0][0]) > HELD:
                    yield from rows(*held.pop())
        if held:
            yield from rows(*merged(held))

    return raw(docs).select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> list[float]:
    """Chen and Goodman's three discounts from the numbers of n-grams seen once to four
    times; without any of them the usual constants for large tables."""
    n = counts.agg(*[F.coalesce(F.sum(F.when(F.col("n") == k, 1)), F.lit(0)) for k in (1, 2, 3, 4)]).first()
    if not all(n):
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05 * k), 0.95 * k) for k in (1, 2, 3)]


def _discount(d: list[float]) -> Column:
    n = F.col("n")
    return F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def smoothed(counts: DataFrame, order: int = ORDER, bits: int = BITS) -> list[tuple[DataFrame, DataFrame]]:
    """From order 1 up: (``gram, p``) and (``context, weight``), all stored.

    Below the highest order a gram counts the different symbols before it; grams
    that begin with an edge have none and keep their number of occurrences.
    """
    tables = [counts]
    for k in range(order - 1, 0, -1):
        gram = F.col("gram").bitwiseAND((1 << bits * k) - 1)
        edge = F.shiftright(gram, bits * (k - 1)) == 0
        n = F.when(F.first(edge) & F.lit(k > 1), F.sum("n")).otherwise(F.count(F.lit(1)))
        tables.append(materialize(tables[-1].groupBy(gram.alias("gram")).agg(n.alias("n")), "quality-grams"))
    out: list[tuple[DataFrame, DataFrame]] = []
    for k, table in enumerate(reversed(tables), 1):
        d, n = discounts(table), F.col("n")
        table = table.withColumn("context", F.shiftright("gram", bits))
        left = F.sum(F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])) / F.sum("n")
        weights = materialize(table.groupBy("context").agg(F.sum("n").alias("total"), left.alias("weight")), "quality-weights")
        found = table.join(weights, "context").withColumn("own", (n - _discount(d)) / F.col("total"))
        if out:
            below = out[-1][0].select(F.col("gram").alias("rest"), F.col("p").alias("lower"))
            found = found.withColumn("rest", F.col("gram").bitwiseAND((1 << bits * (k - 1)) - 1)).join(below, "rest")
        else:
            found = found.withColumn("lower", F.lit(1.0 / (1 << bits)))
        probabilities = materialize(found.select("gram", (F.col("own") + F.col("weight") * F.col("lower")).alias("p")), "quality-model")
        out.append((probabilities, weights.select("context", "weight")))
    return out


@dataclass
class SortedHashes:
    """Hashes in order with a value each; the hash is one to one."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> SortedHashes:
        hashes = mixed(keys.astype(np.uint64))
        order = np.argsort(hashes)
        return cls(hashes[order], values[order].astype(np.float64))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values and which keys were found."""
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys), bool)
        hashes = mixed(keys.astype(np.uint64))
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return self.values[at], self.keys[at] == hashes


@dataclass
class KneserNey:
    """The finished model: per order the log10 probabilities and back-off weights."""

    grams: list[SortedHashes]
    weights: list[SortedHashes]
    bits: int = BITS

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """Of n-grams of the model's order; unseen ones back off to shorter ones."""
        out = np.zeros(len(codes))
        left = np.arange(len(codes))
        for k in range(len(self.grams), 0, -1):
            own = codes[left] & np.uint32((1 << self.bits * k) - 1)
            value, found = self.grams[k - 1].find(own)
            out[left[found]] += value[found]
            left, own = left[~found], own[~found]
            if not len(left):
                return out
            value, found = self.weights[k - 1].find(own >> np.uint32(self.bits))
            out[left[found]] += value[found]
        out[left] -= np.log10(1 << self.bits)
        return out


def fit(docs: DataFrame, order: int = ORDER, alphabet: Alphabet = CLASSED) -> KneserNey:
    """The model of all texts; two numbers of each n-gram and context come to the driver."""
    tables = smoothed(materialize(gram_counts(docs, order, alphabet), "quality-counts"), order, alphabet.bits)
    arrays = []
    for key, value in (("gram", "p"), ("context", "weight")):
        at = (t[key == "context"].select(key, F.log10(value).alias("x")).toArrow() for t in tables)
        arrays.append([SortedHashes.of(x.column(key).to_numpy(), x.column("x").to_numpy()) for x in at])
    return KneserNey(*arrays, alphabet.bits)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def repeated_words(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Per text its words, and its words in windows that occur twice or more in it."""
    h, owner = hashed_words(texts)
    n = np.bincount(owner, minlength=len(texts))
    g = gram_hashes(h, window)
    inside = np.flatnonzero(owner[: len(g)] == owner[window - 1 :][: len(g)])
    key = mixed(g[inside] + owner[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = np.flatnonzero(np.diff(key[order]) == 0)
    starts = inside[order[np.union1d(same, same + 1)]]
    edge = np.bincount(starts, minlength=len(h) + 1) - np.bincount(starts + window, minlength=len(h) + 1)
    covered = np.cumsum(edge)[: len(h)] > 0
    return n, np.bincount(owner[covered], minlength=len(texts))


def sums_by_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n)


def measured(docs: DataFrame, model: KneserNey, order: int = ORDER, alphabet: Alphabet = CLASSED) -> DataFrame:
    """``doc_id, lang`` and per row the base's counts, its symbols and their log10 probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches):
            texts = [t or b"" for t in b.column("text").to_pylist()]
            size = len(texts)
            line = np.frombuffer(b"".join(texts), np.uint8)
            byte_owner = np.repeat(np.arange(size), [len(t) for t in texts])
            n_words, n_repeat = repeated_words(texts)
            codes, owner = grams(texts, order, alphabet)
            logs = sums_by_text(shared.value.log10(codes), owner, size)
            numbers = (
                n_words,
                np.bincount(byte_owner[COUNTED[line]], minlength=size),
                np.bincount(byte_owner[IS_MARK[line]], minlength=size),
                [repeated_lines(t) for t in texts],
                n_repeat,
                np.bincount(owner, minlength=size),
            )
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("lang"), *(pa.array(x, pa.int64()) for x in numbers), pa.array(logs, pa.float64())],
                names=["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_events", "log_prob"],
            )

    numbers = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_events long"
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return raw(docs, lang.alias("lang")).mapInArrow(run, f"doc_id long, lang string, {numbers}, log_prob double")


def bands(scores: DataFrame, width: float = WIDTH) -> DataFrame:
    """``lang, lower, upper`` in log10 perplexity: the median of a language's documents
    that pass the base rules, and ``width`` times their scaled median deviation to
    either side. All of them count, through a histogram; the medians of all languages
    weigh as much as ``POOLED`` documents, which settles languages with few."""
    step = F.floor(F.col("log_ppl") / STEP).cast("long")
    hist = materialize(scores.where(~F.col("base_failed")).groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("n")), "quality-steps")
    all_middle = hist.agg(F.expr("percentile(step, 0.5D, n)")).first()[0] or 0.0
    each = hist.groupBy("lang").agg(F.expr("percentile(step, 0.5D, n)").alias("own_middle"), F.sum("n").alias("n_docs"))
    own = F.col("n_docs") / (F.col("n_docs") + POOLED)
    blend = lambda mine, all_: own * F.col(mine) + (1 - own) * F.lit(float(all_))
    middle = materialize(each.withColumn("middle", blend("own_middle", all_middle)), "quality-middles")
    away = hist.alias("h").join(middle.alias("m"), F.col("h.lang").eqNullSafe(F.col("m.lang"))).select(
        F.col("m.lang").alias("lang"), "n", F.abs(F.col("step") - F.col("own_middle")).alias("away")
    )
    away = materialize(away, "quality-away")
    all_spread = away.agg(F.expr("percentile(away, 0.5D, n)")).first()[0] or 0.0
    each = away.groupBy("lang").agg(F.expr("percentile(away, 0.5D, n)").alias("own_spread"))
    found = middle.alias("m").join(each.alias("e"), F.col("m.lang").eqNullSafe(F.col("e.lang")))
    half = width * 1.4826 * F.greatest(blend("own_spread", all_spread), F.lit(LEAST_STEPS))
    return materialize(found.select(
        F.col("m.lang").alias("lang"), ((F.col("middle") - half) * STEP).alias("lower"), ((F.col("middle") + 1 + half) * STEP).alias("upper")
    ), "quality-bands")


def judge(docs: DataFrame, order: int = ORDER, width: float = WIDTH, alphabet: Alphabet = CLASSED) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, log_ppl, lower, upper`` for every row.

    NULL and blank texts have no words and fail the base. Rows are judged one by one,
    repeated ones alike, whatever their ids; a NULL or absent ``lang`` is a language of
    its own. Texts count whole: a task holds about 1 MB of text at once, or one longer
    text with some 80 bytes of working memory for each of its bytes. A perplexity on
    the edge of a band is inside. Windows are compared by 64-bit hashes. An empty table
    gives no rows. Other columns are left behind, so names can't clash.
    """
    found = measured(docs, fit(docs, order, alphabet), order, alphabet)
    found = found.withColumn("log_ppl", -F.col("log_prob") / F.col("n_events")).withColumn(
        "base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    )
    found = materialize(found, "quality-scores")
    inside = F.coalesce(F.col("log_ppl").between(F.col("b.lower"), F.col("b.upper")), F.lit(False))
    return found.alias("s").join(bands(found, width).alias("b"), F.col("s.lang").eqNullSafe(F.col("b.lang")), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"), "log_ppl", "b.lower", "b.upper",
    )


@catalog.add()
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under the base rules and the perplexity band of their language, by bytes."""
    return judge(documents(spark, sf_dir), alphabet=BYTES)
