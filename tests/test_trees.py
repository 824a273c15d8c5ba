import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vereda.operators import models as md, trees as tr


def training(spark, n=600):
    base = spark.range(n).select("id", *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(m)) / 10.0).alias(c) for c, m in (("a", 400), ("b", 60), ("c", 20))])
    return md.training_frame(base.withColumn("y", (F.col("a") + 5 * F.col("b") + F.col("c") > 36).cast("int")), "id", ["a", "b", "c"], "y").localCheckpoint()


def scores(model, df):
    out = model.transform(df).select("id", vector_to_array("probability").alias("p"), "prediction", vector_to_array("rawPrediction").alias("r")).orderBy("id").collect()
    assert all(sum(r["p"]) == pytest.approx(1) and r["prediction"] == float(r["r"][1] > r["r"][0]) for r in out)
    return [r["p"][1] for r in out], [r["prediction"] for r in out]


def test_forest_is_grown_in_tasks(spark, monkeypatch):
    """Training sets of some size give a model that the driver holds no nodes of, the same
    however rows are dealt; few rows go to Spark ML."""
    df = training(spark)
    assert not isinstance(md.forest(trees=2, depth=2).fit(df), tr.TreeModel)
    monkeypatch.setattr(tr, "FEW_ROWS", 100)
    model = md.forest(trees=30, depth=6, leaf=2).fit(df)
    assert isinstance(model, tr.TreeModel) and isinstance(md.area_forest(trees=2).fit(df), tr.TreeModel)
    share, said = scores(model, df)
    assert (share, said) == scores(md.forest(trees=30, depth=6, leaf=2).fit(df.repartition(5)), df)
    truth = [r["label"] for r in df.orderBy("id").collect()]
    assert np.mean(np.array(truth) == said) > 0.95
    assert share == pytest.approx([r[0] for r in model.transform(df).select(vector_to_array("probability")[1], "id").orderBy("id").collect()])
    assert sum(model.featureImportances) == pytest.approx(1) and model.featureImportances.argmin() == 2
    assert model.transform(df.limit(0)).count() == 0


def test_trees_follow_the_rules_of_spark_ml(spark, monkeypatch):
    """Where nothing is drawn, trees, importances and boosting rounds are Spark ML's."""
    df = training(spark)
    for estimator in (md.forest(trees=1, depth=5, leaf=3).setFeatureSubsetStrategy("all").setBootstrap(False), md.boosted(rounds=6).setMaxDepth(3)):
        theirs = estimator.fit(df)
        monkeypatch.setattr(tr, "FEW_ROWS", 100)
        ours = estimator.fit(df)
        monkeypatch.undo()
        assert isinstance(ours, tr.TreeModel) and not isinstance(theirs, tr.TreeModel)
        assert scores(ours, df)[0] == pytest.approx(scores(theirs, df)[0])
        assert list(ours.featureImportances) == pytest.approx(list(theirs.featureImportances.toArray()))


def test_what_spark_ml_refuses_it_still_refuses(spark, monkeypatch):
    monkeypatch.setattr(tr, "FEW_ROWS", 100)
    for bad in (F.lit(-1.0), F.lit(0.5), F.lit(2.0)):
        with pytest.raises(Exception):
            md.boosted(rounds=1).fit(training(spark, 200).withColumn("label", bad))


def test_wide_levels_and_pieces(monkeypatch):
    """Histograms of few nodes at a time give the same tree; stored in pieces it scores the same."""
    r = np.random.default_rng(5)
    x = r.integers(0, 8, (4, 900)).astype(np.uint8)
    y = ((x[0] ^ x[1]) + r.integers(0, 2, 900) > 4).astype(np.int64)
    p = {"trees": 6, "classes": 2, "bins": 8, "depth": 9, "leaf": 1, "few": 2, "seed": 42, "drawn": True}
    cuts = [np.arange(7) + 0.5] * 4
    whole = list(tr.forest_trees(x, y, cuts, list(range(6)), p))
    monkeypatch.setattr(tr, "NODES", 7)
    again = list(tr.forest_trees(x, y, cuts, list(range(6)), p))
    assert all((a[c] == b[c]).all() for a, b in zip(whole, again, strict=True) for c in ("feature", "cut", "left", "value"))
    values = x.astype(float)
    for most in (1, 1 << 20):
        monkeypatch.setattr(tr, "PIECE", most)
        stored = [tuple(b.column(c)[0].as_py() for c in ("sizes", "feature", "threshold", "left", "value")) for b in tr.pieces(iter(whole))]
        assert len(stored) == (6 if most == 1 else 1)
        total = sum(tr.scored_by(s, values, 2, 9) for s in stored)
        direct = sum(t["value"][:, tr.leaves(t, x, lambda v, at, t=t: v > t["cut"][at], 9)] for t in whole)
        assert total == pytest.approx(direct)


def test_cuts_lie_between_values():
    assert tr.cuts_of(np.array([3.0, 1.0, 3.0, 2.0]), 4).tolist() == [1.5, 2.5]
    assert tr.cuts_of(np.ones(5), 4).tolist() == []
    shares = np.bincount(np.searchsorted(tr.cuts_of(np.arange(1000.0), 32), np.arange(1000.0)))
    assert len(shares) == 32 and shares.max() - shares.min() <= 2


def test_models_and_folds_of_a_forest_go_side_by_side(spark, monkeypatch):
    """Both models of a job are fitted at once, and the folds of a forest that no driver holds."""
    import threading

    df, together = training(spark), {n: threading.Barrier(n, timeout=60) for n in (2, 3)}
    monkeypatch.setattr(tr, "FEW_ROWS", 100)

    def meeting(n):
        class Meeting(tr.Forest):
            def _fit(self, dataset):
                together[n].wait()  # breaks unless n fits run at once
                return super()._fit(dataset)

        return Meeting(labelCol="label", featuresCol="features", numTrees=2, maxDepth=2, seed=1)

    assert list(md.train_all({"a": meeting(2), "b": meeting(2)}, df)) == ["a", "b"]
    assert sorted(r["fold"] for r in md.cross_validate_f1(meeting(3), df, "id", k=3).collect()) == [0, 1, 2]
