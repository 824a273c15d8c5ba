"""Toxicity by a chain of linear classifiers.

The categories are predicted in turn; the model of a category sees the words of a
text and the probabilities of the categories before it. In training these are
out-of-fold predictions, so later models do not learn from fitted answers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from bindings.common import Catalog
from vereda.llm.common import documents, raw
from vereda.session import materialize

catalog = Catalog()

#: bounds of the fit: labelled rows (the first by hash of the id), features, folds
LABELLED, FEATURES, FOLDS = 20_000, 4096, 3
CHAIN = ("quality", "toxic")
#: lengths of the word beginnings used as features beside whole words
BEGINNINGS = (4, 5, 6)
EDGES = ".,;:!?\"'()[]{}<>*_-#…«»„“”¡¿"


def word_features(word: str) -> list[str]:
    w = word.strip(EDGES)
    if not w:
        return []
    return [f"w:{w}", *(f"p{k}:{w[:k]}" for k in BEGINNINGS if len(w) > k)]


def text_features(text: bytes | None) -> set[str]:
    """Distinct words without outer punctuation, in lower case, and their beginnings."""
    out: set[str] = set()
    for w in set((text or b"").decode("utf-8", "replace").lower().split()):
        out.update(word_features(w))
    return out


@dataclass
class Chain:
    """Weights by feature (a column per category), intercepts, and the weights of
    the earlier categories' probabilities."""

    categories: list[str]
    place: dict[str, int]
    weights: np.ndarray
    intercept: np.ndarray
    earlier: np.ndarray

    def probabilities(self, found: list[list[int]]) -> np.ndarray:
        """One row per text, given the places of its features."""
        n = np.array([len(f) for f in found])
        flat = np.array([i for f in found for i in f], np.int64)
        owner = np.repeat(np.arange(len(found)), n)
        out = np.zeros((len(found), len(self.categories)))
        for k in range(len(self.categories)):
            z = self.intercept[k] + np.bincount(owner, weights=self.weights[flat, k], minlength=len(found)) + out[:, :k] @ self.earlier[k, :k]
            out[:, k] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return out


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: list[str], most: int) -> DataFrame:
    """``doc_id, text`` and one 0/1 column per category for at most ``most`` labelled
    documents; several labels of a document count as their maximum, NULL as 0. Rows that
    share an id count as one, with the least of their texts."""
    y = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*[F.max(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"y_{i}") for i, c in enumerate(categories)])
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # bounded by ``most`` rows of a few numbers, so the texts stay where they are
    known = raw(docs).join(F.broadcast(y), "doc_id")
    return known.groupBy(*y.columns).agg(F.min("text").alias("text"))


def chosen_features(sample: DataFrame, k: int, most: int) -> list[str]:
    """The features that tell the categories apart best, by chi-squared of presence;
    features of fewer than three texts are left out."""

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        rows = np.zeros(k + 1)

        def flush():
            names = list(counts)
            table = np.array([counts[f] for f in names]).reshape(len(names), k + 1)
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array(table[:, i]) for i in range(k + 1))], names=["feature", *(f"n{i}" for i in range(k + 1))])
            counts.clear()
            return out

        for b in batches:
            ys = np.stack([b.column(f"y_{i}").to_numpy() for i in range(k)], axis=1)
            for text, y in zip(b.column("text").to_pylist(), ys, strict=True):
                add = np.append(y > 0, True).astype(float)
                rows += add
                for f in text_features(text):
                    if f in counts:
                        counts[f] += add
                    else:
                        counts[f] = add.copy()
                if len(counts) > 300_000:
                    yield flush()
        counts[""] = rows
        yield flush()

    table = sample.mapInArrow(run, "feature string, " + ", ".join(f"n{i} double" for i in range(k + 1)))
    table = materialize(table.groupBy("feature").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(k + 1)]), "toxic-features")
    whole = table.where("feature = ''").first()
    if whole is None:
        return []
    n, scores = whole[k + 1], []
    for i in range(k):
        p, a, m = whole[i + 1], F.col(f"n{i}"), F.col(f"n{k}")
        spread = m * (n - m) * p * (n - p)
        scores.append(F.when(spread > 0, F.pow(a * n - m * p, 2) * n / spread).otherwise(0.0))
    best = F.greatest(*scores, F.lit(0.0)) if k > 1 else scores[0]
    top = table.where(f"feature != '' and n{k} >= 3").orderBy(best.desc(), "feature").limit(most).select("feature")
    return sorted(r[0] for r in top.collect())


def fit_chain(docs: DataFrame, labels: DataFrame, categories=CHAIN, most: int = LABELLED, features: int = FEATURES) -> Chain:
    """Fits the chain on a bounded sample of labelled documents. A category without
    both answers in the sample has the constant share as its probability. Features that
    tell equally much are taken by name. Bytes that are no UTF-8 read as U+FFFD. Texts
    count whole, however long; empty tables give a chain that finds nothing."""
    categories, k = list(categories), len(categories)
    sample = materialize(labelled_sample(docs, labels, categories, most), "toxic-sample")
    names = chosen_features(sample, k, features)
    place = {f: i for i, f in enumerate(names)}
    weights, intercept, earlier = np.zeros((len(names), k)), np.full(k, -20.0), np.zeros((k, k))
    if not names:
        return Chain(categories, place, weights, intercept, earlier)
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def run(batches):
        for b in batches:
            found = [sorted(text_features(t) & shared.value.keys()) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(found, pa.list_(pa.string()))], names=[*kept, "found"])

    kept = ["doc_id", *(f"y_{i}" for i in range(k))]
    found = sample.mapInArrow(run, "doc_id long, " + "".join(f"y_{i} double, " for i in range(k)) + "found array<string>")
    vectors = CountVectorizerModel.from_vocabulary(names, inputCol="found", outputCol="words").setBinary(True).transform(found)
    data = vectors.select(*kept, "words", F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)).alias("fold"))
    # a bounded number of short rows: one task an iteration is enough
    data = materialize(data.coalesce(1), "toxic-data")
    for i in range(k):
        inputs = ["words", *(f"p_{j}" for j in range(i))]
        rows = VectorAssembler(inputCols=inputs, outputCol="x").transform(data.coalesce(1))

        def fit(part, i=i):
            share = part.agg(F.avg(f"y_{i}")).first()[0]
            if share in (None, 0.0, 1.0):
                return share or 0.0
            model = LogisticRegression(featuresCol="x", labelCol=f"y_{i}", predictionCol="_guess", probabilityCol="_p", rawPredictionCol="_raw", regParam=1e-5, standardization=False, maxIter=40)
            return model.fit(part.select("x", f"y_{i}"))

        final = fit(rows)
        if isinstance(final, float):
            intercept[i] = np.log(max(final, 1e-9) / max(1 - final, 1e-9))
        else:
            w = final.coefficients.toArray()
            weights[:, i], earlier[i, :i], intercept[i] = w[: len(names)], w[len(names) :], final.intercept
        if i + 1 < k:
            parts = []
            for f in range(FOLDS):
                model, held = fit(rows.where(F.col("fold") != f)), rows.where(F.col("fold") == f)
                if isinstance(model, float):
                    parts.append(held.withColumn(f"p_{i}", F.lit(model)))
                else:
                    parts.append(model.transform(held).withColumn(f"p_{i}", vector_to_array("_p")[1]))
            out = parts[0].select(*data.columns, f"p_{i}")
            for p in parts[1:]:
                out = out.union(p.select(*data.columns, f"p_{i}"))
            data = materialize(out, "toxic-folds")
    return Chain(categories, place, weights, intercept, earlier)


class Places(dict):
    """Feature places of a word, remembered per task; forgets when full."""

    def __init__(self, place: dict[str, int]):
        self.place = place

    def __missing__(self, word: bytes) -> list[int]:
        if len(self) > 500_000:
            self.clear()
        self[word] = got = [self.place[f] for f in word_features(word.decode()) if f in self.place]
        return got


def _found(texts: list[bytes | None], places: Places) -> list[list[int]]:
    out = []
    for t in texts:
        got: set[int] = set()
        for w in set((t or b"").decode("utf-8", "replace").lower().encode().split()):
            got.update(places[w])
        out.append(sorted(got))
    return out


def score_toxicity(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id`` and the probability of each category as ``p_<category>``. NULL and
    blank texts have no features and get the intercepts' probabilities; every row
    is scored by itself, repeated ones alike. Other columns are left behind."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = ["doc_id", *(f"p_{c}" for c in chain.categories)]

    def run(batches):
        places = Places(shared.value.place)
        for b in batches:
            p = shared.value.probabilities(_found(b.column("text").to_pylist(), places))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(p[:, i]) for i in range(p.shape[1]))], names=names)

    return raw(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"`{n}` double" for n in names[1:]))


def drop_toxic(docs: DataFrame, chain: Chain, limit: float = 0.5) -> DataFrame:
    """The rows whose last category's probability is below ``limit``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at = docs.columns.index("text")

    def run(batches):
        places = Places(shared.value.place)
        for b in batches:
            texts = pc.cast(b.column(at), pa.binary()).to_pylist()
            yield b.filter(pa.array(shared.value.probabilities(_found(texts, places))[:, -1] < limit))

    return docs.mapInArrow(run, docs.schema)


@catalog.add()
def op4_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its probabilities; ``toxic`` from 0.5, ``kept`` otherwise."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_toxicity(docs, fit_chain(docs, labels))
    return scored.select("*", (F.col("p_toxic") >= 0.5).alias("toxic"), (F.col("p_toxic") < 0.5).alias("kept"))
