"""Model queries: whole training jobs on parts and labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import Catalog, r6, table
from bindings.scoring import PART_COLS, part_indicators
from vereda.functions import text as tx
from vereda.operators import attribution as at, evaluation as ev, models as md, scoring as sc
from vereda.operators.sampling import split_stratified
from vereda.plans import areas, tabular
from vereda.session import materialize, scratch_path

catalog = Catalog()

TEXT_COLS = ["n_chars", "n_words", "n_distinct", "n_lines"]


def document_facts(spark, sf):
    """Numbers about every labelled document, with its quality as M or B."""
    words = tx.word_tokens(F.col("text"))
    facts = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "n_chars", F.size(words).alias("n_words"), F.size(F.array_distinct(words)).alias("n_distinct"),
        F.size(F.split("text", "\n")).alias("n_lines"),
        F.when(F.col("quality") == 1, "M").otherwise("B").alias("diagnosis"),
    )
    return materialize(facts, "facts")


def part_training(spark, sf):
    """(p_partkey, features, label, is_test): balance labels from the score."""
    parts = part_indicators(spark, sf)
    scored = materialize(
        sc.weighted_score(parts, sc.critic_weights(parts, PART_COLS, normalize=True), PART_COLS), "scored"
    )
    labelled = sc.balanced_label(scored)
    flat = md.training_frame(labelled, "p_partkey", PART_COLS, "target")
    return materialize(split_stratified(flat, "p_partkey", "label"), "training")


def halves(split):
    return split.where("not is_test").drop("is_test"), split.where("is_test").drop("is_test")


@catalog.add()
def tabular_job(spark, sf):
    """Logistic regression and forest at the job's defaults."""
    return tabular.run(document_facts(spark, sf), "doc_id", TEXT_COLS)


@catalog.add()
def classifier_logistic(spark, sf):
    train, test = halves(part_training(spark, sf))
    return md.evaluate(md.logistic(train.count()).fit(train), test)


@catalog.add()
def classifier_forest(spark, sf):
    train, test = halves(part_training(spark, sf))
    return md.evaluate(md.area_forest().fit(md.spread(train)), test)


@catalog.add()
def classifier_boosted(spark, sf):
    train, test = halves(part_training(spark, sf))
    return md.evaluate(md.boosted().fit(md.spread(train)), test)


@catalog.add()
def feature_importance(spark, sf):
    train, _ = halves(part_training(spark, sf))
    return md.feature_importance(md.area_forest().fit(md.spread(train)), PART_COLS)


@catalog.add()
def coefficient_rank(spark, sf):
    train, _ = halves(part_training(spark, sf))
    return md.coefficient_rank(md.logistic(train.count()).fit(train), PART_COLS)


@catalog.add()
def shapley_summary(spark, sf):
    train, _ = halves(part_training(spark, sf))
    model = md.logistic(train.count()).fit(train)
    return at.attribution_summary(at.shapley_sampling(train, model, PART_COLS, "p_partkey"))


def labelled_text(spark, sf, label):
    labels = table(spark, sf, "labels").select("doc_id", label)
    return table(spark, sf, "documents").select("doc_id", "lang", "text").join(labels, "doc_id")


@catalog.add()
def text_classifier(spark, sf):
    _, _, metrics = md.text_classifier_job(labelled_text(spark, sf, "quality"), "doc_id", "text", "quality")
    return metrics


@catalog.add()
def text_fold_f1(spark, sf):
    """Macro F1 over stratified folds of the text classifier."""
    out = md.text_cross_validate(labelled_text(spark, sf, "quality"), "doc_id", "text", "quality")
    return ev.fold_summary(out, "f1_macro", "cv_f1_macro")


@catalog.add()
def routed_sentiment(spark, sf):
    known = materialize(labelled_text(spark, sf, "quality"), "known")
    models = {
        lang: md.text_classifier(known.where(F.col("lang") == lang), "text", "quality")
        for lang in ("en", "es")
    }
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return md.routed_sentiment(docs, models, "lang").select("doc_id", "lang", "model_label", "model_score")


@catalog.add("select count(*) as n_rows, cast(0 as bigint) as n_different from documents join labels using (doc_id)")
def model_roundtrip(spark, sf):
    """A saved and reloaded model predicts the same."""
    known = materialize(labelled_text(spark, sf, "quality"), "known")
    model = md.text_classifier(known, "text", "quality")
    path = scratch_path(spark, "model")
    md.save_model(model, path)
    first = model.transform(known).select("doc_id", F.col("y_pred").alias("before"))
    second = md.load_model(path).transform(known).select("doc_id", F.col("y_pred").alias("after"))
    return first.join(second, "doc_id").agg(
        F.count("*").alias("n_rows"), F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("n_different")
    )


@catalog.add()
def area_job(spark, sf):
    """The whole suitability job at its defaults."""
    parts = part_indicators(spark, sf).withColumnRenamed("p_partkey", "ageb_id")
    return areas.run(parts).metrics


# Logistic regression with a ridge penalty has one optimum. SQL walks to it by Newton's
# steps, each of which solves three equations by Cramer's rule; folds go side by side.
SPLIT = "row_number() over (partition by quality order by md5(doc_id || '|42'), doc_id)"
NEWTON_SQL = f"""
with recursive facts as (select doc_id, quality as y, {SPLIT} as rn, count(*) over (partition by quality) as n,
  n_chars / 1000.0::double as x1, cast(len(list_distinct(string_split(text, ' '))) * 10 // len(string_split(text, ' ')) as double) as x2 from documents join labels using (doc_id)),
split as (select *, rn <= ceil(0.2 * n) as is_test from facts),
{{groups}},
newton(i, g, b0, b1, b2) as (
  select 0, g, 0.0::double, 0.0::double, 0.0::double from (select distinct g from train)
  union all
  select i + 1, g, b0 - (r0 * m00 - r1 * m01 + r2 * m02) / det, b1 - (-r0 * m01 + r1 * m11 - r2 * m12) / det, b2 - (r0 * m02 - r1 * m12 + r2 * m22) / det
  from (select *, h11 * h22 - h12 * h12 as m00, h01 * h22 - h02 * h12 as m01, h01 * h12 - h02 * h11 as m02,
      h00 * h22 - h02 * h02 as m11, h00 * h12 - h01 * h02 as m12, h00 * h11 - h01 * h01 as m22,
      h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h02 * h12) + h02 * (h01 * h12 - h02 * h11) as det
    from (select i, g, b0, b1, b2, sum(p - y) as r0, sum((p - y) * x1) + b1 as r1, sum((p - y) * x2) + b2 as r2,
        sum(w) as h00, sum(w * x1) as h01, sum(w * x2) as h02, sum(w * x1 * x1) + 1 as h11, sum(w * x1 * x2) as h12, sum(w * x2 * x2) + 1 as h22
      from (select newton.*, y, x1, x2, p, p * (1 - p) as w from (select newton.*, y, x1, x2, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) as p
          from newton join train using (g) where i < 25) newton) group by i, g, b0, b1, b2))),
fitted as (select * from newton where i = 25)
"""
ONE_FIT = NEWTON_SQL.format(groups="train as (select 0 as g, * from split where not is_test), held as (select 0 as g, * from split where is_test)")
FOLD_FITS = NEWTON_SQL.format(
    groups="train as (select g, split.* from split, range(5) f(g) where (rn - 1) % 5 <> g), held as (select (rn - 1) % 5 as g, * from split)"
)
JUDGED_FITS = """, judged as (select g, y, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) as s from held join fitted using (g)),
c as (select g, count(*) filter (y = 0 and s <= 0.5) as tn, count(*) filter (y = 0 and s > 0.5) as fp,
  count(*) filter (y = 1 and s <= 0.5) as fn, count(*) filter (y = 1 and s > 0.5) as tp from judged group by g)
"""


def variety():
    """Tenths of the space-separated words that are different."""
    return F.expr("size(array_distinct(split(text, ' '))) * 10 div size(split(text, ' '))").alias("variety")


def length_features(spark, sf):
    """(doc_id, features, label, is_test): length and share of different words of the labelled documents."""
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "quality", (F.col("n_chars") / 1000.0).alias("thousands"), variety()
    )
    flat = md.training_frame(rows, "doc_id", ["thousands", "variety"], "quality")
    return materialize(split_stratified(flat, "doc_id", "label"), "lengths")


@catalog.add(ONE_FIT + """select 'thousands' as feature, round(b1, 2) + 0.0 as coefficient from fitted
union all select 'variety', round(b2, 2) + 0.0 from fitted""")
def logistic_optimum(spark, sf):
    """Coefficients of the library's regression against the optimum itself."""
    train, _ = halves(length_features(spark, sf))
    ranked = md.coefficient_rank(md.logistic(train.count()).fit(train), ["thousands", "variety"])
    return ranked.select("feature", r6("coefficient", 2).alias("coefficient"))


@catalog.add(ONE_FIT + JUDGED_FITS + """select tn, fp, fn, tp, round((tp + tn) / (tn + fp + fn + tp), 6) as accuracy,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1_score from c""")
def logistic_holdout(spark, sf):
    """The regression judged on the rows held out."""
    train, test = halves(length_features(spark, sf))
    out = md.evaluate(md.logistic(train.count()).fit(train), test)
    return out.select("tn", "fp", "fn", "tp", r6("accuracy").alias("accuracy"), r6("f1_score").alias("f1_score"))


@catalog.add(FOLD_FITS + JUDGED_FITS + """, m as (select coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1 from c)
select round(avg(f1), 6) as cv_f1_mean, round(stddev_pop(f1), 6) as cv_f1_std from m""")
def logistic_folds(spark, sf):
    """F1 over five folds, a fit for each."""
    rows = length_features(spark, sf).drop("is_test")
    # four fifths of the rows train, and the penalty counts rows
    folds = md.cross_validate_f1(md.logistic(round(0.8 * rows.count())), rows, "doc_id")
    out = ev.fold_summary(folds)
    return out.select(r6("cv_f1_mean").alias("cv_f1_mean"), r6("cv_f1_std").alias("cv_f1_std"))


# One tree of depth one: the best of all cuts, tried one by one in SQL.
STUMP_SQL = f"""
with facts as (select doc_id, quality as y, {SPLIT} as rn, count(*) over (partition by quality) as n,
  len(list_distinct(string_split(text, ' '))) * 10 // len(string_split(text, ' ')) as x1, case when lang = 'en' then 1 else 0 end as x2 from documents join labels using (doc_id)),
train as (select * from facts where rn > ceil(0.2 * n)), held as (select * from facts where rn <= ceil(0.2 * n)),
vals as (select 'variety' as feature, x1 as x, y from train union all select 'english', x2, y from train),
cuts as (select distinct feature, x as cut from vals),
sides as (select c.feature, cut, count(*) filter (x <= cut) as l, coalesce(sum(y) filter (x <= cut), 0) as lp, count(*) filter (x > cut) as r, coalesce(sum(y) filter (x > cut), 0) as rp
  from cuts c join vals v using (feature) group by c.feature, cut),
best as (select *, 2.0 * lp * (l - lp) / l + 2.0 * rp * (r - rp) / r as impurity from sides where l > 0 and r > 0 order by impurity, feature desc, cut limit 1),
judged as (select y, case when (case when feature = 'variety' then x1 else x2 end) <= cut then 2 * lp > l else 2 * rp > r end as p from held, best)
"""


def stump_features(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "quality", variety(),
        (F.col("lang") == "en").cast("int").alias("english"),
    )
    flat = md.training_frame(rows, "doc_id", ["variety", "english"], "quality")
    return materialize(split_stratified(flat, "doc_id", "label"), "stumps")


@catalog.add(STUMP_SQL + """select f.feature, cast(case when f.feature = best.feature and (2 * lp > l) <> (2 * rp > r) then 1 else 0 end as double) as importance
from best, (select 'variety' as feature union all select 'english') f""")
def stump_importance(spark, sf):
    """A forest of one tree of depth one gives all importance to the best cut, and none
    if both sides of it predict the same, for such a cut is pruned."""
    train, _ = halves(stump_features(spark, sf))
    return md.feature_importance(md.forest(trees=1, depth=1).setFeatureSubsetStrategy("all").fit(train), ["variety", "english"])


@catalog.add(STUMP_SQL + """select count(*) filter (y = 0 and not p) as tn, count(*) filter (y = 0 and p) as fp,
  count(*) filter (y = 1 and not p) as fn, count(*) filter (y = 1 and p) as tp from judged""")
def stump_holdout(spark, sf):
    """The same tree judged on the rows held out."""
    train, test = halves(stump_features(spark, sf))
    return md.evaluate(md.forest(trees=1, depth=1).setFeatureSubsetStrategy("all").fit(train), test).select("tn", "fp", "fn", "tp")


@catalog.add(STUMP_SQL + """select count(*) filter (y = 0 and not p) as tn, count(*) filter (y = 0 and p) as fp,
  count(*) filter (y = 1 and not p) as fn, count(*) filter (y = 1 and p) as tp from judged""")
def boosted_first_round(spark, sf):
    """One round of boosting over trees of depth one takes the same cut: on two classes
    the squared error falls with the impurity."""
    train, test = halves(stump_features(spark, sf))
    return md.evaluate(md.boosted(rounds=1).setMaxDepth(1).setFeatureSubsetStrategy("all").fit(train), test).select("tn", "fp", "fn", "tp")
