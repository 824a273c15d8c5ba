"""Classifier training on Spark ML: one split, several models, whole jobs."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    IndexToString,
    Normalizer,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from vereda.functions import text as tx
from vereda.operators import evaluation as ev
from vereda.operators.quality import drop_blank, drop_missing, require_classes, require_columns
from vereda.operators.sampling import assign_folds, split_stratified
from vereda.operators.stats import attach_row
from vereda.operators.tfidf import ROW_GROUP, cut_tokens, known_terms, token_vocabulary
from vereda.operators.trees import Boosted, Forest, in_tasks
from vereda.session import materialize

T = TypeVar("T")

SEED = 42
#: training rows of a task, at least
TASK_ROWS = 2000


def logistic(rows: int, label: str = "label", features: str = "features") -> LogisticRegression:
    """Logistic regression with unit strength of the penalty on the summed loss,
    which is 1/rows on Spark's mean loss."""
    return LogisticRegression(
        labelCol=label, featuresCol=features, maxIter=1000, regParam=1.0 / max(rows, 1),
        elasticNetParam=0.0, standardization=False,
    )


def forest(label: str = "label", features: str = "features", trees: int = 100, depth: int = 30, leaf: int = 1) -> RandomForestClassifier:
    """A row's node in every tree is kept, so a level sends no trees and walks none."""
    return Forest(
        labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=SEED,
        cacheNodeIds=True,
    )


def area_forest(label: str = "label", features: str = "features", trees: int = 300) -> RandomForestClassifier:
    """Two leaves of at least two rows imply a split of at least four."""
    return forest(label, features, trees, depth=16, leaf=2)


def boosted(label: str = "label", features: str = "features", rounds: int = 250) -> GBTClassifier:
    return Boosted(
        labelCol=label, featuresCol=features, maxIter=rounds, stepSize=0.05, maxDepth=5,
        featureSubsetStrategy="0.9", subsamplingRate=1.0, seed=SEED,
    )


def training_frame(df: DataFrame, id_col: str, cols: list[str], target: str) -> DataFrame:
    """(id, features, label): numbers with 0 for missing, label as an integer."""
    require_columns(df, [*cols, target], "required columns")
    x = [F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in cols]
    flat = df.select(id_col, F.col(target).cast("int").alias("label"), *x)
    assembled = VectorAssembler(inputCols=cols, outputCol="features").transform(flat)
    return assembled.select(id_col, "features", "label")


def spread(train: DataFrame) -> DataFrame:
    """Training rows dealt to all cores: a stored table of some megabytes is one split,
    and a fit keeps the splits that it is given. Small tables stay as they are."""
    tasks = min(train.sparkSession.sparkContext.defaultParallelism, train.count() // TASK_ROWS)
    if tasks < 2:
        return train
    key = [F.xxhash64(*train.columns), *[c for c, kind in train.dtypes if kind != "vector"]]
    return train.repartition(tasks, *key).sortWithinPartitions(*key)


def predictions(model: Model, df: DataFrame) -> DataFrame:
    """Adds ``y_pred`` and, where the model gives probabilities, ``score``."""
    out = model.transform(df)
    if "probability" in out.columns:
        out = out.withColumn("score", vector_to_array("probability")[1])
    return out.withColumn("y_pred", F.col("prediction").cast("int"))


def evaluate(model: Model, df: DataFrame, label: str = "label") -> DataFrame:
    """One row: confusion counts, accuracy, precision, recall, F1 and AUC."""
    scored = predictions(model, df)
    # AUC takes several passes; the model is asked once
    scored = materialize(scored.select(*[c for c in (label, "y_pred", "score") if c in scored.columns]), "judged")
    metrics = ev.binary_metrics(scored, label, "y_pred")
    if "score" not in scored.columns:
        return metrics.withColumn("roc_auc", F.lit(None).cast("double"))
    return attach_row(metrics, ev.roc_auc(scored, label, "score").select("roc_auc"), "_a").select(
        *metrics.columns, "_a.roc_auc"
    )


def side_by_side(spark: SparkSession, step: Callable[[int], T], k: int, at_once: int) -> list[T]:
    """``step`` of 0 to ``k - 1``, ``at_once`` at a time on threads of the driver."""
    with ThreadPool(at_once) as pool:
        return pool.map(inheritable_thread_target(spark)(step), range(k), chunksize=1)


def train_all(models: dict[str, Estimator], train: DataFrame) -> dict[str, Model]:
    """Fit several estimators on one stored training set, side by side."""
    train = spread(materialize(train, "train"))
    fits = side_by_side(train.sparkSession, lambda i: list(models.values())[i].fit(train), len(models), len(models))
    return dict(zip(models, fits, strict=True))


def cross_validate_f1(
    estimator: Estimator, train: DataFrame, id_col: str, label: str = "label", k: int = 5, seed: int | None = SEED
) -> DataFrame:
    """(fold, f1_score) for ``k`` stratified folds. Folds go side by side, for most models
    take many short jobs; forests of Spark ML one by one, since the driver holds a whole one."""
    folds = materialize(assign_folds(train, id_col, label, k, seed), "folds")
    whole = isinstance(estimator, RandomForestClassifier) and not in_tasks(*folds.agg(F.count(F.lit(1)), F.max(F.size(vector_to_array(estimator.getFeaturesCol())))).first())

    def judged(i: int) -> tuple[int, float]:
        model = estimator.fit(spread(folds.where(F.col("fold") != i)))
        scored = predictions(model, folds.where(F.col("fold") == i))
        return i, float(ev.binary_metrics(scored, label, "y_pred").first()["f1_score"])

    rows = side_by_side(train.sparkSession, judged, k, 1 if whole else k)
    return train.sparkSession.createDataFrame(rows, "fold int, f1_score double")


def feature_importance(model: Model, cols: list[str]) -> DataFrame:
    """(feature, importance), largest first; empty when the model has none."""
    values = getattr(model, "featureImportances", None)
    rows = [] if values is None else [(c, float(values[i])) for i, c in enumerate(cols)]
    out = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    return out.orderBy(F.desc("importance"), "feature")


def coefficient_rank(model: Model, names: list[str]) -> DataFrame:
    """(feature, coefficient), largest absolute value first."""
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray())]
    out = SparkSession.active().createDataFrame(rows, "feature string, coefficient double")
    return out.orderBy(F.desc(F.abs("coefficient")), "feature")


def text_stages(vocabulary: DataFrame, text: str, ngrams: tuple[int, int] = (1, 2)) -> list:
    """Transformers from text to unit TF-IDF vectors. The vocabulary, bounded by
    its ``max_features``, becomes part of the model, so scoring needs no join
    and no shuffle."""
    rows = vocabulary.select("term", "idf").orderBy("term").collect()
    words = "filter(split(lower(coalesce({t}, '')), '[^\\\\p{{L}}\\\\p{{N}}_]+'), t -> length(t) >= 2)".format(t=text)
    runs = ", ".join(
        "_words" if n == 1 else
        f"if(size(_words) >= {n}, transform(sequence(1, size(_words) - {n - 1}), "
        f"i -> array_join(slice(_words, i, {n}), ' ')), array())"
        for n in range(ngrams[0], ngrams[1] + 1)
    )
    return [
        SQLTransformer(statement=f"SELECT *, {words} AS _words FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, concat({runs}) AS _terms FROM __THIS__"),
        CountVectorizerModel.from_vocabulary([r["term"] for r in rows], "_terms", "_tf"),
        ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="_tf", outputCol="_weighted"),
        Normalizer(inputCol="_weighted", outputCol="features", p=2.0),
    ]


#: leading stages of ``text_stages`` that make the terms of a text
WORD_STAGES = 2


def usable_text(df: DataFrame, text: str, label: str) -> DataFrame:
    kept = drop_blank(drop_missing(df, [text, label]), text)
    return require_classes(kept, label)


def text_classifier(
    train: DataFrame, text: str, label: str, max_features: int = 5000, ngrams: tuple[int, int] = (1, 2)
) -> PipelineModel:
    """TF-IDF and logistic regression; vocabulary and idf from training rows."""
    words = train.select(F.col(label).alias("_y"), tx.word_tokens(F.col(text)).alias("tokens"))
    return classifier_of_words(materialize(words, "train", ROW_GROUP), text, max_features, ngrams)


def classifier_of_words(words: DataFrame, text: str, max_features: int = 5000, ngrams: tuple[int, int] = (1, 2)) -> PipelineModel:
    """``text_classifier`` of stored (_y, tokens); only the terms of frequent words are made."""
    tokens = cut_tokens(words, max_features)
    stages = text_stages(token_vocabulary(tokens, ngrams, max_features), text, ngrams)
    index = StringIndexer(inputCol="_y", outputCol="_label", stringOrderType="alphabetAsc").fit(words)
    terms = tokens.select("_y", known_terms(F.col("tokens"), ngrams).alias("_terms"))
    vectors = PipelineModel([index, *stages[WORD_STAGES:]]).transform(terms)
    fitted = logistic(words.count(), "_label").fit(vectors.select("_label", "features"))
    back = IndexToString(inputCol="prediction", outputCol="y_pred", labels=index.labels)
    # new rows may come without a label, so the label index is not part of it
    return PipelineModel([*stages, fitted, back])


def text_classifier_job(
    df: DataFrame, id_col: str, text: str = "lemma_text", label: str = "segment_label", **options
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(model, evaluation rows, metrics row) for a stratified split."""
    usable = usable_text(df.select(id_col, text, label), text, label)
    split = split_stratified(usable, id_col, label)
    model = text_classifier(split.where("not is_test"), text, label, **options)
    rows = model.transform(split.where("is_test")).select(
        id_col, F.col(text).alias("text"), F.col(label).cast("string").alias("y_true"), "y_pred"
    )
    return model, rows, ev.macro_metrics(rows, "y_true", "y_pred")


def text_cross_validate(
    df: DataFrame, id_col: str, text: str, label: str, k: int = 5, **options
) -> DataFrame:
    """(fold, accuracy, ..., f1_macro): vocabulary, idf and model per fold. Texts are
    cut into words once for all folds, which go side by side."""
    folds = assign_folds(usable_text(df.select(id_col, text, label), text, label), id_col, label, k)
    words = folds.select("fold", F.col(label).alias("_y"), tx.word_tokens(F.col(text)).alias("tokens"))
    words = materialize(words, "folds", ROW_GROUP)

    def judged(i: int) -> DataFrame:
        model = classifier_of_words(words.where(F.col("fold") != i).drop("fold"), text, **options)
        held = words.where(F.col("fold") == i).withColumnRenamed("tokens", "_words")
        scored = PipelineModel(model.stages[1:]).transform(held)
        # labels are compared as text, as the classifier returns them
        row = ev.macro_metrics(scored.withColumn("_y", F.col("_y").cast("string")), "_y", "y_pred")
        return materialize(row.select(F.lit(i).alias("fold"), "*"), "fold")

    return ev.union_all(side_by_side(df.sparkSession, judged, k, k))


def routed_sentiment(
    df: DataFrame, models: dict[str, PipelineModel], lang: str = "language", prefix: str = "model"
) -> DataFrame:
    """Score each row with the model of its language: label and highest class
    probability; languages without a model give "not_applicable"."""
    label, score = f"{prefix}_label", f"{prefix}_score"
    keep = df.columns
    if not models:
        return df.withColumn(label, F.lit("not_installed")).withColumn(score, F.lit(None).cast("double"))
    parts = [
        model.transform(df.where(F.col(lang) == name)).select(
            *keep, F.col("y_pred").cast("string").alias(label),
            F.array_max(vector_to_array("probability")).alias(score),
        )
        for name, model in models.items()
    ]
    rest = df.where(~F.coalesce(F.col(lang).isin(*models), F.lit(False)))
    parts.append(rest.withColumn(label, F.lit("not_applicable")).withColumn(score, F.lit(None).cast("double")))
    return ev.union_all(parts)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
