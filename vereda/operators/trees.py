"""Forests and boosted trees grown in tasks, on rows of one byte per feature.

Spark ML holds all nodes of a forest on the driver and sends a histogram of each node
for every split of the rows. Here the features are cut into bins as Spark ML cuts them,
the binned rows go to every task, and a task grows whole trees; these are stored in
pieces of bounded size. The driver holds the binned rows, and one piece at a time.

The rules are Spark ML's: gini or variance, a random choice of features for each node,
Poisson weights for the rows of a forest's tree, leaves merged that predict the same,
importances by gain. Draws depend on the seed, the tree and the rows only, neither on
their order nor on their partitions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from vereda.session import materialize

#: rows below which Spark ML still grows trees, and bytes of binned rows that every task may hold;
#: training sets beyond that go to Spark ML again
FEW_ROWS, MOST_BYTES = 4000, 64 << 20
#: rows that decide the bins, as in Spark ML
SAMPLE_ROWS = 10_000
#: nodes whose histograms are held at once; bytes of a stored piece of an ensemble, and of
#: the pieces that a worker keeps between batches
NODES, PIECE, KEPT = 16_384, 4 << 20, 64 << 20
#: gains below this are rounding
NO_GAIN = 1e-12
#: parameters that the trees here follow; an estimator with others set is left to Spark ML
FOLLOWED = {
    "labelCol", "featuresCol", "numTrees", "maxDepth", "minInstancesPerNode", "seed", "cacheNodeIds",
    "maxBins", "featureSubsetStrategy", "maxIter", "stepSize", "subsamplingRate", "bootstrap",
}


def cuts_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between the bins of one feature: between all its values if they are
    few, else where the running count comes nearest to equal shares."""
    found, counts = np.unique(values, return_counts=True)
    if len(found) <= bins:
        return (found[:-1] + found[1:]) / 2.0
    stride = len(values) / bins
    target, out = stride, []
    upto = np.cumsum(counts).tolist()
    for i in range(1, len(found)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append((found[i - 1] + found[i]) / 2.0)
            target += stride
    return np.array(out)


class Gini:
    """Sums of the rows' weights per class."""

    def __init__(self, y: np.ndarray, w: np.ndarray, classes: int):
        self.y, self.w, self.classes = y, w, classes

    def where(self, keep: np.ndarray) -> Gini:
        return Gini(self.y[keep], self.w[keep], self.classes)

    def sums(self, key: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(key * self.classes + self.y, self.w, size * self.classes).reshape(size, self.classes).T

    @staticmethod
    def sizes(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of rows, and the square whose mean falls with the impurity."""
        return sums.sum(0), (sums * sums).sum(0)

    @classmethod
    def settled(cls, sums: np.ndarray) -> np.ndarray:
        n, square = cls.sizes(sums)
        return square >= n * n


class Variance:
    """Number of the rows and sum of their values."""

    def __init__(self, y: np.ndarray):
        self.y = y

    def where(self, keep: np.ndarray) -> Variance:
        return Variance(self.y[keep])

    def sums(self, key: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(key, minlength=size).astype(float), np.bincount(key, self.y, size)])

    @staticmethod
    def sizes(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return sums[0], sums[1] * sums[1]

    @staticmethod
    def settled(sums: np.ndarray) -> np.ndarray:
        return np.zeros(sums.shape[1], bool)


def valued(x: np.ndarray, feature: np.ndarray, row: np.ndarray) -> np.ndarray:
    """``x[feature, row]`` of a contiguous ``x``."""
    return x.ravel().take(feature * np.int64(x.shape[1]) + row)


def best_cuts(x: np.ndarray, rows: Gini | Variance, node: np.ndarray, sums: np.ndarray, bins: int, leaf: int, few: int, rng: np.random.Generator):
    """(gain, feature, cut) of every node: ``x`` and ``rows`` are in ``node``."""
    k, m = len(x), sums.shape[1]
    chosen = np.sort(rng.random((m, k)).argsort(1)[:, :few], 1) if few < k else None
    n, square = rows.sizes(sums)
    best, feature, cut = np.full(m, -np.inf), np.zeros(m, np.int16), np.zeros(m, np.uint8)
    if m > NODES:
        order = np.argsort(node, kind="stable")
        x, rows, node = x.take(order, 1), rows.where(order), node[order]
    for a in range(0, m, NODES):
        z = min(a + NODES, m)
        if m > NODES:
            lo, hi = np.searchsorted(node, [a, z])
            part = slice(lo, hi)
        else:
            part = slice(None)
        own, at, xs = rows.where(part), (node[part] - a).astype(np.int64), np.ascontiguousarray(x[:, part])
        base, row = at * bins, np.arange(xs.shape[1])
        for j in range(few):
            asked = np.full(z - a, j, np.int16) if chosen is None else chosen[a:z, j].astype(np.int16)
            b = xs[j] if chosen is None else valued(xs, asked[at], row)
            left = own.sums(base + b, (z - a) * bins).reshape(-1, z - a, bins).cumsum(2)[:, :, :-1]
            (ln, lq), (rn, rq) = rows.sizes(left), rows.sizes(sums[:, a:z, None] - left)
            with np.errstate(divide="ignore", invalid="ignore"):
                score = lq / ln + rq / rn
            score[(ln < leaf) | (rn < leaf)] = -np.inf
            c = score.argmax(1)
            score = score[np.arange(z - a), c]
            better = score > best[a:z]
            best[a:z][better], feature[a:z][better], cut[a:z][better] = score[better], asked[better], c[better]
    return (best - square / n) / n, feature, cut


def grow(x: np.ndarray, rows: Gini | Variance, bins: int, depth: int, leaf: int, few: int, rng: np.random.Generator, merge: bool) -> dict[str, np.ndarray]:
    """One tree, level by level: feature (-1 at leaves), cut, left child (the right one
    follows it), sums and gain of each node. Rows leave with the nodes that are done."""
    node = np.zeros(x.shape[1], np.int32)
    sums = rows.sums(node.astype(np.int64), 1)
    levels, born = [], 1
    for level in range(depth + 1):
        m = sums.shape[1]
        feature, cut, left, gain = np.full(m, -1, np.int16), np.zeros(m, np.uint8), np.zeros(m, np.int32), np.zeros(m)
        levels.append((feature, cut, left, sums, gain))
        is_open = ~rows.settled(sums) & (rows.sizes(sums)[0] >= 2 * leaf)
        if level == depth or not is_open.any():
            break
        if not is_open.all():
            keep = np.flatnonzero(is_open[node])
            x, rows, node = x.take(keep, 1), rows.where(keep), (np.cumsum(is_open) - 1).astype(np.int32)[node[keep]]
        gains, features, cuts = best_cuts(x, rows, node, sums[:, is_open], bins, leaf, few, rng)
        split = gains > NO_GAIN
        if not split.any():
            break
        at = np.flatnonzero(is_open)[split]
        feature[at], cut[at], gain[at] = features[split], cuts[split], gains[split]
        left[at] = born + 2 * np.arange(len(at))
        born += 2 * len(at)
        if not split.all():
            keep = np.flatnonzero(split[node])
            x, rows, node = x.take(keep, 1), rows.where(keep), node[keep]
        right = valued(x, features[node], np.arange(x.shape[1])) > cuts[node]
        node = (2 * (np.cumsum(split) - 1)[node] + right).astype(np.int32)
        sums = rows.sums(node.astype(np.int64), 2 * len(at))
    edges = np.cumsum([0, *[len(f) for f, *_ in levels]])
    feature, cut, left, gain = (np.concatenate([v[i] for v in levels]) for i in (0, 1, 2, 4))
    sums = np.concatenate([v[3] for v in levels], 1)
    if merge:
        says = sums.argmax(0)
        for a, z in zip(edges[-2::-1], edges[:0:-1], strict=True):
            inner = a + np.flatnonzero(feature[a:z] >= 0)
            pair = left[inner]
            feature[inner[(feature[pair] < 0) & (feature[pair + 1] < 0) & (says[pair] == says[pair + 1])]] = -1
    inner = np.flatnonzero(feature >= 0)
    kept = np.sort(np.concatenate([[0], left[inner], left[inner] + 1]))
    place = np.zeros(len(feature), np.int32)
    place[kept] = np.arange(len(kept))
    return {"feature": feature[kept], "cut": cut[kept], "left": place[left[kept]], "sums": sums[:, kept], "gain": gain[kept]}


def leaves(tree: dict[str, np.ndarray], x: np.ndarray, test: Callable[[np.ndarray, np.ndarray], np.ndarray], depth: int) -> np.ndarray:
    """The leaf of every row; ``test`` tells which of some rows go right at their nodes."""
    node, moving = np.zeros(x.shape[1], np.int32), np.arange(x.shape[1])
    for _ in range(depth):
        at = node[moving]
        inner = tree["feature"][at] >= 0
        moving, at = moving[inner], at[inner]
        if not len(moving):
            break
        node[moving] = tree["left"][at] + test(valued(x, tree["feature"][at], moving), at)
    return node


def importance(tree: dict[str, np.ndarray], n: np.ndarray, k: int) -> np.ndarray:
    inner = tree["feature"] >= 0
    return np.bincount(tree["feature"][inner], tree["gain"][inner] * n[inner], k)


def forest_trees(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], numbers: list[int], p: dict) -> Iterator[dict]:
    """Trees ``numbers`` of a forest; their values are shares of the classes."""
    for t in numbers:
        rng = np.random.Generator(np.random.Philox(key=[p["seed"] % 2**64, t]))
        w = rng.poisson(1.0, len(y)).astype(np.int16) if p["drawn"] else np.ones(len(y), np.int16)
        drawn = np.flatnonzero(w)
        tree = grow(x.take(drawn, 1), Gini(y[drawn], w[drawn].astype(float), p["classes"]), p["bins"], p["depth"], p["leaf"], p["few"], rng, True)
        n = tree["sums"].sum(0)
        weight = importance(tree, n, len(x))
        with np.errstate(invalid="ignore"):
            value = np.where(n > 0, tree["sums"] / n, 0.0)
        yield tree | {"number": t, "value": value, "importance": weight / (weight.sum() or 1.0), "threshold": thresholds(tree, cuts)}


def boosted_trees(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], p: dict) -> Iterator[dict]:
    """Rounds of boosting on the log loss of labels -1 and 1; the first tree counts whole."""
    sign = 2.0 * y - 1.0
    total, wanted = np.zeros(len(y)), sign
    for t in range(p["trees"]):
        rng = np.random.Generator(np.random.Philox(key=[p["seed"] % 2**64, t]))
        tree = grow(x, Variance(wanted), p["bins"], p["depth"], p["leaf"], p["few"], rng, False)
        value = tree["sums"][1] / tree["sums"][0] * (p["step"] if t else 1.0)
        total += value[leaves(tree, x, lambda v, at, cut=tree["cut"]: v > cut[at], p["depth"])]
        wanted = 4.0 * sign / (1.0 + np.exp(np.minimum(2.0 * sign * total, 700.0)))
        yield tree | {"number": t, "value": value[None], "importance": importance(tree, tree["sums"][0], len(x)), "threshold": thresholds(tree, cuts)}


def thresholds(tree: dict[str, np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(tree["feature"]))
    for f, c in enumerate(cuts):
        at = tree["feature"] == f
        out[at] = c[tree["cut"][at]]
    return out


PIECE_SCHEMA = "first int, sizes binary, feature binary, threshold binary, left binary, value binary, importance array<double>"


def pieces(trees: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Trees behind one another in rows of about ``PIECE`` bytes."""
    held, size = [], 0

    def seal():
        sizes = np.array([len(t["feature"]) for t in held], np.int32)
        whole = [np.concatenate([t[c] for t in held]) for c in ("feature", "threshold", "left")]
        value = np.concatenate([t["value"] for t in held], 1)
        blobs = [sizes, whole[0].astype(np.int16), whole[1], whole[2].astype(np.int32), value]
        weight = np.sum([t["importance"] for t in held], 0)
        return pa.RecordBatch.from_arrays(
            [pa.array([held[0]["number"]], pa.int32()), *[pa.array([b.tobytes()], pa.binary()) for b in blobs], pa.array([weight.tolist()], pa.list_(pa.float64()))],
            names=["first", "sizes", "feature", "threshold", "left", "value", "importance"],
        )

    for t in trees:
        held.append(t)
        size += len(t["feature"]) * (14 + 8 * len(t["value"]))
        if size >= PIECE:
            yield seal()
            held, size = [], 0
    if held:
        yield seal()


def scored_by(piece: tuple, x: np.ndarray, values: int, depth: int) -> np.ndarray:
    """Summed values of a stored piece's trees, one row per value."""
    sizes, *blobs = piece
    feature, threshold, left = (np.frombuffer(b, t) for b, t in zip(blobs, (np.int16, np.float64, np.int32)))
    value = np.frombuffer(blobs[3], np.float64).reshape(values, -1)
    out, a = np.zeros((values, x.shape[1])), 0
    for n in np.frombuffer(sizes, np.int32).tolist():
        own = {"feature": feature[a : a + n], "left": left[a : a + n]}
        limit = threshold[a : a + n]
        out += value[:, a : a + n][:, leaves(own, x, lambda v, at, limit=limit: v > limit[at], depth)]
        a += n
    return out


class TreeModel:
    """An ensemble in stored pieces, which tasks read one by one. ``margin`` tells a sum
    of trees from votes."""

    def __init__(self, shared: list[Broadcast], size: int, weights: np.ndarray, values: int, depth: int, features: str, margin: bool):
        self.shared, self.kept, self.values, self.depth, self.features, self.margin = shared, size <= KEPT, values, depth, features, margin
        self.featureImportances = weights / (weights.sum() or 1.0)

    def sums(self) -> Column:
        shared, kept, values, depth = self.shared, self.kept, self.values, self.depth

        @F.arrow_udf("array<double>")
        def voted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for b in batches:
                x = np.ascontiguousarray(b.flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1).T)
                out = np.zeros((values, len(b)))
                for piece in shared:
                    out += scored_by(piece.value, x, values, depth) if len(b) else 0.0
                    if not kept:
                        vars(piece).pop("_value", None)
                ends = np.arange(len(b) + 1, dtype=np.int32) * values
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(out.T.ravel()))

        return voted(vector_to_array(self.features))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds rawPrediction, probability and prediction, the first class winning ties."""
        scored = df.withColumn("_v", self.sums())
        if self.margin:
            up = 1.0 / (1.0 + F.exp(-2.0 * F.col("_v")[0]))
            raw, share = F.array(-F.col("_v")[0], F.col("_v")[0]), F.array(1.0 - up, up)
        else:
            raw, share = F.col("_v"), F.transform("_v", lambda v: v / F.aggregate("_v", F.lit(0.0), lambda a, b: a + b))
        scored = scored.withColumn("_r", raw)
        most = (F.array_position("_r", F.array_max("_r")) - 1).cast("double")
        return scored.withColumns(
            {"rawPrediction": array_to_vector("_r"), "probability": array_to_vector(share), "prediction": most}
        ).drop("_v", "_r")


def features_asked(strategy: str, k: int, trees: int, boosting: bool) -> int | None:
    """How many of ``k`` features a node looks at; None for rules that only Spark ML knows."""
    if strategy == "all" or (strategy == "auto" and (boosting or trees == 1)):
        return k
    if strategy in ("auto", "sqrt"):
        return math.ceil(math.sqrt(k))
    try:
        share = float(strategy)
    except ValueError:
        return None
    return math.ceil(k * share) if "." in strategy and 0 < share <= 1 else None


def in_tasks(n: int, k: int) -> bool:
    """Whether ``n`` rows of ``k`` features are grown in tasks, and not by Spark ML."""
    return FEW_ROWS <= n <= MOST_BYTES // (k + 1)


def fitted(estimator: RandomForestClassifier | GBTClassifier, train: DataFrame) -> TreeModel | None:
    """``estimator`` fitted in tasks, or None if the rows are few, do not fit into every
    task, or are asked for in a way that only Spark ML knows."""
    if not {p.name for p in estimator._paramMap} <= FOLLOWED or estimator.getSubsamplingRate() != 1.0:
        return None
    boosting = isinstance(estimator, GBTClassifier)
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    rows = train.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    n, k, top, low, bad = rows.agg(
        F.count(F.lit(1)), F.max(F.size("x")), F.max("y"), F.min("y"),
        F.count_if(F.col("y").isNull() | (F.col("y") != F.floor("y")) | F.exists("x", lambda v: F.isnan(v) | (F.abs(v) == math.inf))),
    ).first()
    # what Spark ML refuses it shall refuse in its own words
    if not n or not in_tasks(n, k) or bad or low < 0 or top >= (2 if boosting else 100):
        return None
    trees = estimator.getMaxIter() if boosting else estimator.getNumTrees()
    few, bins = features_asked(estimator.getFeatureSubsetStrategy(), k, trees, boosting), min(estimator.getMaxBins(), n)
    if few is None or bins > 256:
        return None
    sample = rows if n <= SAMPLE_ROWS else rows.orderBy(F.xxhash64("x", "y"), "x", "y").limit(SAMPLE_ROWS)
    seen = np.array([r["x"] for r in sample.select("x").collect()])
    cuts = [cuts_of(seen[:, j], bins) for j in range(k)]

    def binned(batches):
        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, k)
                out = np.empty((b.num_rows, k + 1), np.uint8)
                for j in range(k):
                    out[:, j] = np.searchsorted(cuts[j], x[:, j])
                out[:, k] = b.column("y").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["rows"])

    whole = np.frombuffer(b"".join(bytes(r["rows"]) for r in rows.mapInArrow(binned, "rows binary").toLocalIterator()), np.uint8).reshape(-1, k + 1)
    # in an order of their own, so that draws do not depend on partitions
    whole = whole[np.lexsort(whole.T)]
    spark = train.sparkSession
    held = spark.sparkContext.broadcast((np.ascontiguousarray(whole[:, :k].T), whole[:, k].astype(np.int64)))
    p = {
        "trees": trees, "classes": int(top) + 1, "bins": bins, "depth": estimator.getMaxDepth(), "seed": estimator.getSeed(),
        "leaf": estimator.getMinInstancesPerNode(), "few": few, "step": estimator.getStepSize() if boosting else 0.0,
        "drawn": not boosting and estimator.getBootstrap(),
    }

    def run(batches):
        x, y = held.value
        numbers = [t for b in batches for t in b.column("id").to_pylist()]
        if numbers:
            yield from pieces(boosted_trees(x, y, cuts, p) if boosting else forest_trees(x, y, cuts, numbers, p))

    # a boosted tree needs the ones before it; trees of a forest are dealt in turn
    tasks = 1 if boosting else min(trees, 4 * spark.sparkContext.defaultParallelism)
    stored = materialize(spark.range(0, 1 if boosting else trees, 1, tasks).mapInArrow(run, PIECE_SCHEMA), "trees")
    held.destroy()
    shared, size, weights = [], 0, np.zeros(k)
    for r in stored.orderBy("first").toLocalIterator():
        piece = tuple(bytes(r[c]) for c in ("sizes", "feature", "threshold", "left", "value"))
        shared.append(spark.sparkContext.broadcast(piece))
        size += sum(map(len, piece))
        weights += np.array(r["importance"])
    return TreeModel(shared, size, weights, 1 if boosting else p["classes"], p["depth"], features, boosting)


class Forest(RandomForestClassifier):
    """Spark ML's forest; training sets of some size are grown in tasks."""

    def _fit(self, dataset):
        return fitted(self, dataset) or super()._fit(dataset)


class Boosted(GBTClassifier):
    """Spark ML's boosted trees; training sets of some size are grown in one task."""

    def _fit(self, dataset):
        return fitted(self, dataset) or super()._fit(dataset)
