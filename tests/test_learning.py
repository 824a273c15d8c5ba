import inspect
import json
from pathlib import Path
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from bindings import learning
from vereda.operators import attribution as at, evaluation as ev, models as md, sampling as sm
from vereda.plans import areas, reviews, tabular
from vereda.operators import language as lg


def expand(spark, matrix, labels):
    """Prediction rows that give a confusion matrix."""
    cells = [(labels[i], labels[j], n) for i, row in enumerate(matrix) for j, n in enumerate(row)]
    df = spark.createDataFrame(cells, "y {0}, p {0}, n int".format("int" if isinstance(labels[0], int) else "string"))
    return df.where("n > 0").select("y", "p", F.explode(F.sequence(F.lit(1), F.col("n"))))


# published confusion matrices and the metrics printed with them
GOLDEN = [
    ([[70, 1], [2, 41]], 0.9736842105263158, 0.9761904761904762, 0.9534883720930233, 0.9647058823529412),
    ([[70, 1], [3, 40]], 0.9649122807017544, 0.975609756097561, 0.9302325581395349, 0.9523809523809523),
    ([[206, 1], [3, 204]], 0.9903381642512077, 0.9951219512195122, 0.9855072463768116, 0.9902912621359223),
    ([[202, 5], [2, 205]], 0.9830917874396136, 0.9761904761904762, 0.9903381642512077, 0.9832134292565947),
]


@pytest.mark.parametrize("matrix, accuracy, precision, recall, f1", GOLDEN)
def test_published_binary_metrics(spark, matrix, accuracy, precision, recall, f1):
    r = ev.binary_metrics(expand(spark, matrix, [0, 1]), "y", "p").first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == tuple(sum(matrix, []))
    assert (r["accuracy"], r["precision"], r["recall"], r["f1_score"]) == pytest.approx((accuracy, precision, recall, f1))


def test_published_macro_metrics(spark):
    df = expand(spark, [[2172, 139], [115, 2194]], ["pros", "cons"])
    r = ev.macro_metrics(df, "y", "p").first()
    assert tuple(r) == pytest.approx((0.945021645021645, 0.9450679224397913, 0.9450238835523854, 0.9450203983186591))
    report = {x["label"]: x for x in ev.class_report(df, "y", "p").collect()}
    assert report["pros"]["support"] == 2311 and report["weighted avg"]["support"] == 4620


def test_metrics_without_predictions(spark):
    r = ev.binary_metrics(expand(spark, [[5, 0], [3, 0]], [0, 1]), "y", "p").first()
    assert (r["precision"], r["recall"], r["f1_score"]) == (0.0, 0.0, 0.0)


def auc_by_pairs(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("per_task", [1000, 7])
def test_auc_equals_pair_count(spark, per_task):
    rows = [(i * 7 % 3 == 0, float(i * 13 % 20)) for i in range(90)]
    df = spark.createDataFrame([(int(y), s) for y, s in rows], "y int, s double")
    assert ev.roc_auc(df, "y", "s", per_task).first()["roc_auc"] == pytest.approx(auc_by_pairs(rows))
    last = ev.roc_points(df, "y", "s", per_task).orderBy("threshold").first()
    assert (last["fpr"], last["tpr"]) == (1.0, 1.0)


def test_auc_needs_both_classes_and_handles_ties(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double")
    assert ev.roc_auc(df, "y", "s").first()["roc_auc"] is None
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, s double")
    assert ev.roc_auc(tied, "y", "s").first()["roc_auc"] == 0.5


def test_splits_are_exact_and_stable(spark):
    df = spark.range(103).withColumn("label", (F.col("id") % 3 == 0).cast("int"))
    for split in (lambda d: sm.split_random(d, "id"), lambda d: sm.split_stratified(d, "id", "label")):
        a = {r["id"]: r["is_test"] for r in split(df).collect()}
        b = {r["id"]: r["is_test"] for r in split(df.repartition(7)).collect()}
        assert a == b and len(a) == 103
        assert sum(a.values()) in (21, 22)
    per_class = {r["label"]: r["n"] for r in sm.split_stratified(df, "id", "label").where("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert per_class == {1: 7, 0: 14}


@pytest.mark.parametrize("seed", [42, None])
def test_folds_are_balanced(spark, seed):
    df = spark.range(53).withColumn("label", (F.col("id") < 20).cast("int"))
    folds = sm.assign_folds(df, "id", "label", 5, seed)
    sizes = folds.groupBy("label").pivot("fold", [0, 1, 2, 3, 4]).count().collect()
    for r in sizes:
        assert max(r[1:]) - min(r[1:]) <= 1 and sum(r[1:]) == (20 if r["label"] else 33)


def test_linear_contributions_sum_to_the_score(spark):
    df = spark.createDataFrame([(1, (0.1, 0.4)), (2, (0.3, 0.2))], "id int, _part struct<a:double,b:double>")
    got = at.linear_attribution(df, "id", ["a", "b"]).groupBy("id").agg(F.sum("contribution").alias("s")).orderBy("id").collect()
    assert [r["s"] for r in got] == pytest.approx([0.0, 0.0])


def numbers(spark, n=200):
    base = spark.range(n).select(
        "id", (F.col("id") * 37 % 101 / 10.0).alias("a"), (F.col("id") * 53 % 97 / 10.0).alias("b"),
        (F.col("id") * 71 % 89 / 10.0).alias("c"), (F.col("id") * 13 % 83 / 10.0).alias("d"),
    )
    return base.withColumn("y", (F.col("a") + F.col("b") > 9.5).cast("int"))


def test_shapley_sums_to_score_differences(spark):
    df = md.training_frame(numbers(spark, 60), "id", ["a", "b", "c"], "y")
    model = md.logistic(60).fit(df)
    parts = at.shapley_sampling(df, model, ["a", "b", "c"], "id", max_rows=20, permutations=3)
    again = at.shapley_sampling(df.repartition(5), model, ["a", "b", "c"], "id", max_rows=20, permutations=3)
    key = lambda rows: sorted((r["id"], r["feature"], round(r["contribution"], 9)) for r in rows)
    got = parts.collect()
    assert key(got) == key(again.collect()) and len(got) == 60
    top = at.attribution_summary(parts).collect()
    assert {top[0]["feature"], top[1]["feature"]} == {"a", "b"}


def test_tabular_job(spark):
    df = numbers(spark).withColumn("diagnosis", F.when(F.col("y") == 1, "M").otherwise("B")).drop("y")
    out = {r["model"]: r for r in tabular.run(df, "id", ["a", "b", "c", "d"], trees=5, depth=4, folds=2).collect()}
    assert out["logistic"]["accuracy"] > 0.85 and out["logistic"]["roc_auc"] > 0.9
    assert out["logistic"]["tn"] + out["logistic"]["fp"] + out["logistic"]["fn"] + out["logistic"]["tp"] == 40
    assert 0 <= out["rf"]["cv_f1_mean"] <= 1


def test_area_job(spark):
    df = numbers(spark).drop("y").withColumnRenamed("id", "ageb_id")
    r = areas.run(df, boost_rounds=2, trees=5, folds=2, attribution_rows=10, permutations=1)
    assert r.features == ["a", "b", "c", "d"]
    assert {x["model"] for x in r.metrics.collect()} == {"boosted", "random_forest"}
    assert {"suitability_score", "target", "nprv_score"} <= set(r.scored.columns)
    assert r.importances.count() == 8 and r.attributions.count() == 8 and not r.roc.isEmpty()


def test_queries_take_the_job_defaults(monkeypatch):
    assert inspect.signature(areas.run).parameters["attribution_rows"].default is None
    seen = []
    monkeypatch.setattr(learning, "part_indicators", lambda *a: MagicMock())
    monkeypatch.setattr(learning, "document_facts", lambda *a: MagicMock())
    monkeypatch.setattr(learning.areas, "run", lambda df, **k: seen.append(k) or MagicMock())
    monkeypatch.setattr(learning.tabular, "run", lambda df, id_col, cols, **k: seen.append(k))
    learning.area_job(None, ""), learning.tabular_job(None, "")
    assert seen == [{}, {}]


def test_review_job(spark):
    good, bad = ["great team and pay", "the office is nice"], ["long hours and stress", "the boss is rude"]
    rows = [("c", f"t{i}", good[i % 2] + f" word{i % 4}", bad[i % 2] + f" thing{i % 3}") for i in range(20)]
    df = spark.createDataFrame(rows, "company string, review_title string, pros string, cons string")
    known = spark.createDataFrame([("the team and the pay is long", "en"), ("la casa y el pan es bueno", "es")], "t string, lang string")
    stop = spark.createDataFrame([("en", "the")], "lang string, token string")
    lemma = spark.createDataFrame([("en", "hours", "hour")], "lang string, token string, lemma string")
    valence = spark.createDataFrame([("great", 3.0), ("rude", -2.0)], "token string, valence double")
    out = reviews.run(df, lg.learn_profiles(known, "t", "lang"), stop, lemma, valence, max_features=50)
    assert out.segments.count() == 40 and out.label_counts.count() == 2
    assert out.metrics.first()["accuracy"] == 1.0
    assert {r["lexicon_label"] for r in out.lexicon_counts.collect()} <= {"positive", "negative", "neutral", "not_applicable"}
    assert out.model_counts.first()["model_label"] == "not_installed"
    assert out.ngrams.columns == ["lang", "size", "term", "n", "rank"]


def test_training_rows_go_to_all_cores(spark):
    """One split of training rows is dealt out, whole and the same way each time; a small one is not."""
    ids = spark.range(4 * md.TASK_ROWS, numPartitions=1).selectExpr("id", "cast(id % 7 as double) as x", "cast(id % 2 as int) as y")
    train = md.training_frame(ids.unionByName(ids.limit(3).withColumn("id", F.lit(None).cast("long"))), "id", ["x"], "y").coalesce(1)
    dealt = md.spread(train)
    assert dealt.rdd.getNumPartitions() == 4
    assert sorted(map(str, dealt.collect())) == sorted(map(str, train.collect()))
    assert dealt.collect() == md.spread(train.repartition(3)).collect()
    assert md.spread(train.limit(100)).rdd.getNumPartitions() == 1
    assert md.area_forest().getCacheNodeIds()


def test_folds_go_side_by_side(spark):
    import threading

    together = threading.Barrier(3, timeout=30)  # breaks unless three steps run at once
    assert md.side_by_side(spark, lambda i: (together.wait(), i * i)[1], 3, 3) == [0, 1, 4]


def test_folds_share_one_cut_into_words(spark, monkeypatch):
    """Texts are cut into words once for all folds, and the folds' metrics are those of models made one by one."""
    texts = [(i, ("good calm word " if i % 3 else "bad angry word ") * 2 + f"w{i % 5} é_1", int(i % 3 > 0)) for i in range(30)]
    df = spark.createDataFrame([*texts, (30, " ", 1), (31, None, 0)], "id long, text string, y int")
    cut = []
    whole = md.tx.word_tokens
    monkeypatch.setattr(md.tx, "word_tokens", lambda c: (cut.append(1), whole(c))[1])
    found = md.text_cross_validate(df, "id", "text", "y", k=2, max_features=8).orderBy("fold").collect()
    assert len(cut) == 1
    folds = sm.assign_folds(md.usable_text(df, "text", "y"), "id", "y", 2)
    for i, row in enumerate(found):
        model = md.text_classifier(folds.where(F.col("fold") != i), "text", "y", max_features=8)
        scored = model.transform(folds.where(F.col("fold") == i)).withColumn("y", F.col("y").cast("string"))
        assert row[1:] == pytest.approx(tuple(ev.macro_metrics(scored, "y", "y_pred").first()))
