"""A hidden Markov language model trained by distributed Baum-Welch.

States emit the frequent words of the training texts, one symbol for all other
words, and the end of a text. A word behind the common symbol follows a smoothed
unigram distribution over the other words, so the model is proper over all words.
Only the frequent vocabulary and the state tables, whose size is a parameter, are
ever gathered; the counts of all words stay a distributed table.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from bindings.common import Catalog
from vereda.llm.common import documents, raw, task_id
from vereda.session import materialize

catalog = Catalog()

#: bounds of what is gathered: frequent words, and hidden states
VOCABULARY, STATES, ROUNDS = 60_000, 8, 5
#: longest piece of a text in training, and tokens handled at once
PIECE, AT_ONCE = 512, 400_000
ALPHA = 0.1


def folded(text: bytes | None) -> list[bytes]:
    """Words with A-Z in lower case; a NULL text has none."""
    return (text or b"").lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over all texts; the end of a text is the empty word."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def run(batches):
        counts: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=schema)
            counts.clear()
            return out

        for b in batches:
            for t in b.column("text").to_pylist():
                counts.update(folded(t))
                counts[b""] += 1
                if len(counts) > 400_000:
                    yield flush()
        if counts:
            yield flush()

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The words with the highest counts, at most ``most``: the cut falls between
    two of the 32 steps to a doubling of the count."""
    step = F.floor(F.log2(F.col("c").cast("double")) * 32).cast("int")
    steps = counts.where(F.length("word") > 0).groupBy(step.alias("step")).count().collect()
    cut, n = None, 0
    for s, k in sorted(((r["step"], r["count"]) for r in steps), reverse=True):
        if n + k > most:
            break
        cut, n = s, n + k
    if cut is None:
        return {}
    kept = counts.where((step >= cut) & (F.length("word") > 0)).toPandas()
    return dict(sorted(zip(map(bytes, kept["word"]), kept["c"].tolist(), strict=True)))


def encoded(docs: DataFrame, vocabulary: list[bytes], path_label: str = "hmm-codes") -> DataFrame:
    """``row, doc_id, held_out, n_tokens, codes, words, times``: each text as 16-bit
    codes (the last two are the common symbol and the end) and its other words with
    their numbers of occurrences."""
    common = len(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        place = {w: i for i, w in enumerate(shared.value)}
        row = task_id() << 33
        for b in batches:
            out = []
            for doc_id, text, held in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "held_out")), strict=True):
                words = folded(text)
                codes = [place.get(w, common) for w in words]
                other = Counter(w for w, c in zip(words, codes, strict=True) if c == common)
                codes.append(common + 1)
                out.append((row, doc_id, held, len(codes), np.array(codes, np.uint16).tobytes(), list(other), list(other.values())))
                row += 1
            if out:
                kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["row", "doc_id", "held_out", "n_tokens", "codes", "words", "times"],
                )

    texts = docs.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, codes binary, words array<binary>, times array<long>")
    return materialize(texts, path_label)


class States:
    """Start, transition and emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def first(cls, share: np.ndarray, n: int) -> States:
        """Sticky states that each favour other words, by a fixed draw."""
        noise = np.random.default_rng(3).normal(0.0, 1.5, (len(share), n))
        emit = share[:, None] * np.exp(noise)
        move = np.full((n, n), 0.02 / max(n - 1, 1))
        np.fill_diagonal(move, 0.98 if n > 1 else 1.0)
        return cls(np.full(n, 1.0 / n), move, emit / emit.sum(0))

    @classmethod
    def learned(cls, counts: np.ndarray, share: np.ndarray, n: int) -> States:
        """From summed expected counts: emissions, then moves, then starts."""
        v = len(share)
        emit = counts[:v] + 20.0 * share[:, None]
        move = counts[v : v + n] + 0.1
        start = counts[v + n] + 0.1
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def lanes(sequences: list[np.ndarray]):
    """Sequences side by side, longest first: flat codes, where each begins, and how many are still running at each step."""
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    lengths = np.array([len(sequences[i]) for i in order])
    flat = np.concatenate([sequences[i] for i in order]).astype(np.int64)
    begin = np.cumsum(lengths) - lengths
    running = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
    return order, flat, begin, running


def log_likelihoods(sequences: list[np.ndarray], s: States) -> np.ndarray:
    """Exact log10 likelihood of whole sequences by the scaled forward recursion."""
    order, flat, begin, running = lanes(sequences)
    total = np.zeros(len(sequences))
    a = np.tile(s.start, (len(sequences), 1))
    for t, n in enumerate(running.tolist()):
        a = (a[:n] if t == 0 else a[:n] @ s.move) * s.emit[flat[begin[:n] + t]]
        c = a.sum(1)
        a /= c[:, None]
        total[:n] += np.log10(c)
    out = np.empty(len(sequences))
    out[order] = total
    return out


def expected_counts(sequences: list[np.ndarray], s: States) -> np.ndarray:
    """Expected emissions, moves and starts (rows of one table) by forward and backward recursion."""
    order, flat, begin, running = lanes(sequences)
    v, n = s.emit.shape
    alphas, scales = [], []
    a = np.tile(s.start, (len(sequences), 1))
    for t, m in enumerate(running.tolist()):
        a = (a[:m] if t == 0 else a[:m] @ s.move) * s.emit[flat[begin[:m] + t]]
        c = a.sum(1, keepdims=True)
        a = a / c
        alphas.append(a)
        scales.append(c)
    gamma = np.empty((len(flat), n))
    moves = np.zeros((n, n))
    b = np.ones((running[-1], n))
    for t in range(len(running) - 1, -1, -1):
        m = running[t]
        if len(b) < m:
            b = np.concatenate([b, np.ones((m - len(b), n))])
        gamma[begin[:m] + t] = alphas[t] * b
        if t:
            weighed = s.emit[flat[begin[:m] + t]] * b / scales[t]
            moves += alphas[t - 1][:m].T @ weighed
            b = weighed @ s.move.T
    table = np.zeros((v + n + 1, n))
    for k in range(n):
        table[:v, k] = np.bincount(flat, weights=gamma[:, k], minlength=v)
    table[v : v + n] = moves * s.move
    table[v + n] = gamma[begin].sum(0)
    return table


def gathered(batches, least: int):
    """Sequences of several batches, about ``least`` tokens at once."""
    held, size = [], 0
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            held.append(row)
            size += len(row[-1]) // 2
            if size >= least:
                yield held
                held, size = [], 0
    if held:
        yield held


def train(codes: DataFrame, share: np.ndarray, n: int = STATES, rounds: int = ROUNDS) -> States:
    """Baum-Welch: every round goes over all texts; each task sums its expected
    counts, Spark sums the tasks', and the new tables are shared again."""
    spark, s, v = codes.sparkSession, States.first(share, n), len(share)
    names = [f"s{k}" for k in range(n)]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(s)

        def run(batches, shared=shared):
            table = None
            for rows in gathered(batches, AT_ONCE):
                pieces = [x[i : i + PIECE] for (c,) in rows for x in [np.frombuffer(c, np.uint16)] for i in range(0, len(x), PIECE)]
                got = expected_counts(pieces, shared.value)
                table = got if table is None else table + got
            if table is not None:
                at = np.flatnonzero(table.any(1))
                yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(table[at, k]) for k in range(n))], names=["at", *names])

        sums = codes.select("codes").mapInArrow(run, "at long, " + ", ".join(f"{x} double" for x in names))
        got = sums.groupBy("at").agg(*[F.sum(x).alias(x) for x in names]).toPandas()
        counts = np.zeros((v + n + 1, n))
        counts[got["at"].to_numpy(np.int64)] = got[names].to_numpy()
        s = States.learned(counts, share, n)
        shared.unpersist()
    return s


def score_texts(docs: DataFrame, vocabulary: int = VOCABULARY, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Texts whose id has a CRC-32 divisible by 10 are held out; a NULL id reads as
    the empty text and is held out. NULL and blank texts are the end token alone.
    Rows are scored one by one, repeated ones alike. Without training texts the
    base is one unknown type of probability 1 and so is the model.
    """
    spark = docs.sparkSession
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0
    texts = raw(docs).withColumn("held_out", held)
    counts = materialize(word_counts(texts.where(~F.col("held_out")).select("text")), "hmm-counts")
    total, types, ends = counts.agg(F.sum("c"), F.count(F.lit(1)), F.sum(F.when(F.length("word") == 0, F.col("c")))).first()
    total, ends = total or 0, ends or 0
    known = frequent(counts, vocabulary)
    words, seen = list(known), np.array(list(known.values()), float)
    rest, rest_types = total - ends - int(seen.sum()), types - (ends > 0) - len(words)
    share = np.concatenate([seen, [rest + ALPHA, ends + ALPHA]])
    share /= share.sum()
    codes = encoded(texts, words)
    model = spark.sparkContext.broadcast(train(codes.where(~F.col("held_out")), share, states, rounds) if total else States(np.ones(1), np.ones((1, 1)), np.ones((len(share), 1))))
    whole = total + ALPHA * (types + 1)
    base = spark.sparkContext.broadcast(np.concatenate([np.log10((np.append(seen, [0, 0]) + ALPHA) / whole)[:-2], [0.0, math.log10((ends + ALPHA) / whole)]]))

    def run(batches):
        common = len(base.value) - 2
        for rows in gathered(batches, AT_ONCE):
            sequences = [np.frombuffer(r[-1], np.uint16) for r in rows]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.bool_()), pa.array(columns[3], pa.int64()),
                 pa.array([int((s != common).sum()) - (not ends) for s in sequences], pa.int64()),
                 pa.array([float(base.value[s].sum()) for s in sequences]), pa.array(log_likelihoods(sequences, model.value))],
                names=["row", "doc_id", "held_out", "n_tokens", "frequent", "base_part", "model_part"],
            )

    scored = codes.select("row", "doc_id", "held_out", "n_tokens", "codes").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, frequent long, base_part double, model_part double"
    )
    # other words: one row per document and word meets the full counts
    other = codes.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", "x.words", "x.times")
    c = F.coalesce(F.col("c"), F.lit(0))
    other = other.join(counts, other["words"] == counts["word"], "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10(c + ALPHA)).alias("logs"),
        F.sum("times").alias("n"),
    )
    n, logs = F.coalesce("n", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    behind = math.log10(rest + ALPHA * (rest_types + 1))
    return scored.join(other, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("frequent") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_part") + logs - n * math.log10(whole)).alias("base_score"),
        (F.col("model_part") + logs - n * behind).alias("score"),
    )


@catalog.add()
def op3_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text under the unigram base and under the hidden Markov model."""
    return score_texts(documents(spark, sf_dir))
