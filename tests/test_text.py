import pytest
from pyspark.sql import functions as F

from vereda.functions import text as tx
from vereda.operators import extract as ex, language as lg, lexicon as lx, text as tt, tfidf as tf

import math
import random


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Visit https://a.b/c?d=1 NOW!", "visit now"),
        ("www.x.org ÁRBOL 123 niño", "árbol niño"),
        ("¿?!", ""),
        (None, ""),
        ("a b\n c", "a b c"),
    ],
)
def test_clean_text(spark, raw, clean):
    assert one(spark, tx.clean_text, raw) == clean


def test_lengths_and_tokens(spark):
    assert one(spark, tx.text_length, "  a  bb c ") == 3
    assert one(spark, tx.text_length, "   ") == 0
    assert one(spark, tx.text_length, None) == 0
    assert one(spark, tx.word_tokens, "A bc, dé_1 x") == ["bc", "dé_1"]
    assert one(spark, lambda c: tx.ngrams(tx.word_tokens(c), 2), "aa bb cc") == ["aa bb", "bb cc"]
    assert one(spark, lambda c: tx.ngrams(tx.word_tokens(c), 2), "aa") == []
    assert one(spark, tx.trigrams, "Ab") == [" ab", "ab "]
    assert one(spark, tx.trigrams, " ") == []


@pytest.mark.parametrize(
    "url, n, expected",
    [
        ("http://h/a.htm", 1, "http://h/a.htm"),
        ("http://h/a.htm", 3, "http://h/a_IP3.htm"),
        ("http://h/a.html", 2, "http://h/a_IP2.html"),
        ("http://h.htmx/a", 2, "http://h.htmx/a_IP2.htm"),
        ("http://h/a.htm?q=1", 2, "http://h/a_IP2.htm?q=1"),
    ],
)
def test_page_url(spark, url, n, expected):
    assert one(spark, lambda c: tx.page_url(c, F.lit(n)), url) == expected


REVIEWS = [
    ("c", "t1", "good pay", "long hours", None),
    ("c", "t2", "only pros", None, 4.5),
    ("c", "t3", None, " only cons ", 3.0),
    ("c", "t4", "   ", None, None),
]


def test_segments(spark, rows):
    df = spark.createDataFrame(REVIEWS, "company string, title string, pros string, cons string, rating double")
    out = tt.expand_reviews(df)
    assert out.columns == [
        "company", "review_title", "rating", "review_date", "source_url", "page_number", "segment_label", "raw_text",
    ]
    got = [(r["review_title"], r["segment_label"], r["raw_text"]) for r in out.collect()]
    assert sorted(got) == [
        ("t1", "cons", "long hours"), ("t1", "pros", "good pay"), ("t2", "pros", "only pros"), ("t3", "cons", "only cons"),
    ]
    with pytest.raises(ValueError):
        tt.expand_reviews(df.drop("cons"))
    with pytest.raises(ValueError):
        tt.expand_reviews(df.where("title = 't4'"))


def test_top_terms_break_ties_by_term(spark, rows):
    df = spark.createDataFrame([("bb aa bb cc",), ("aa dd",)], "t string")
    assert rows(tt.token_frequency(df, "t", k=3)) == [("aa", 2), ("bb", 2), ("cc", 1)]
    assert rows(tt.top_ngrams(df, "t", 1, 1, 2)) == [("aa", 2), ("bb", 2)]


def test_lemmas_keep_order_and_other_languages(spark):
    df = spark.createDataFrame(
        [(1, "en", "the cats ran the race"), (2, "unknown", "the cats"), (3, "es", "")], "id int, lang string, t string"
    )
    stop = spark.createDataFrame([("en", "the")], "lang string, token string")
    lemma = spark.createDataFrame([("en", "cats", "cat"), ("en", "ran", "run")], "lang string, token string, lemma string")
    got = {r["id"]: r["lemma_text"] for r in lx.lemmatize(df, "id", "t", "lang", stop, lemma).collect()}
    assert got == {1: "cat run race", 2: "the cats", 3: ""}


def sentiment(spark, text, lang="en"):
    df = spark.createDataFrame([(1, lang, text)], "id int, lang string, t string")
    valence = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double")
    mods = spark.createDataFrame(
        [("not", "negation", 0.0), ("very", "booster", 0.293)], "token string, kind string, delta double"
    )
    r = lx.lexicon_sentiment(df, "id", "t", "lang", valence, mods).first()
    return r["lexicon_compound"], r["lexicon_label"]


def test_sentiment_rules(spark):
    norm = lambda s: s / math.sqrt(s * s + 15)
    assert sentiment(spark, "good") == (pytest.approx(norm(2.0)), "positive")
    assert sentiment(spark, "not good") == (pytest.approx(norm(-1.48)), "negative")
    assert sentiment(spark, "very xx bad") == (pytest.approx(norm(-2 - 0.293 * 0.95)), "negative")
    assert sentiment(spark, "not aa bb cc good") == (pytest.approx(norm(2.0)), "positive")
    assert sentiment(spark, "nothing") == (0.0, "neutral")
    assert sentiment(spark, "good", "es") == (None, "not_applicable")


def test_sentiment_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0,)], "s double")
    assert [r[0] for r in df.select(lx.sentiment_label(F.col("s"))).collect()] == ["positive", "negative", "neutral"]


def test_sentiment_without_a_lexicon(spark):
    df = spark.createDataFrame([(1, "en", "x")], "id int, lang string, t string")
    assert lx.lexicon_sentiment(df, "id", "t", "lang", None).first()["lexicon_label"] == "not_installed"


def test_language_rejects_other_languages_and_blank(spark):
    known = spark.createDataFrame(
        [("the house and the garden", "en"), ("la casa y el jardín", "es"), ("das haus und der garten", "de")],
        "t string, lang string",
    )
    profiles = lg.learn_profiles(known, "t", "lang")
    df = spark.createDataFrame(
        [(1, "the garden"), (2, "el jardín"), (3, "der garten und das"), (4, "  "), (5, None)], "id int, t string"
    )
    got = {r["id"]: r["language"] for r in lg.language_tag(df, "id", "t", profiles).collect()}
    assert got == {1: "en", 2: "es", 3: "unknown", 4: "unknown", 5: "unknown"}


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(1, "aa aa bb"), (2, "bb cc")], "id int, t string")
    vocabulary = tf.fit_vocabulary(df, "t", (1, 1), 10)
    idf = {r["term"]: r["idf"] for r in vocabulary.collect()}
    assert idf["bb"] == pytest.approx(1.0) and idf["aa"] == pytest.approx(math.log(3 / 2) + 1)
    got = {(r["id"], r["term"]): r["weight"] for r in tf.tfidf(df, "id", "t", vocabulary, (1, 1)).collect()}
    length = math.hypot(2 * idf["aa"], 1.0)
    assert got[(1, "aa")] == pytest.approx(2 * idf["aa"] / length)
    assert sum(w * w for (i, _), w in got.items() if i == 2) == pytest.approx(1.0)


HTML = """<html><script>var t="<article><h3>no</h3></article>"</script>
<article><h3>Great &amp; kind</h3><p>Consejos</p><p>skip</p><p>Pros</p><p>pay</p><p>Cons<p>hours</article>
<article><p>Pros</p><p>untitled</p></article>
<article><span data-test="review-title">By mark</span><p>Ventajas</p><p>uno</p><p>Desventajas</p></article></html>"""


def test_extract_reviews(spark, rows):
    pages = spark.createDataFrame([(1, HTML)], "page_id int, html string")
    got = rows(ex.extract_reviews(pages).select("review_title", "pros", "cons"), "review_title")
    assert got == [("By mark", "uno", ""), ("Great & kind", "pay", "hours")]


def test_crawl_cutoff(spark, rows):
    counts = {"a": [3, 0, 2, 0, 0, 5], "b": [0, 0, 9], "c": [1, 2, 0]}
    data = [(c, i + 1, n) for c, ns in counts.items() for i, n in enumerate(ns)]
    df = spark.createDataFrame(data, "company string, page_num int, n_reviews int")
    kept = ex.crawl_cutoff(df).groupBy("company").agg(F.max("page_num"))
    assert rows(kept, "company") == [("a", 5), ("b", 2), ("c", 3)]


def test_crawl_cutoff_across_ranges(spark, rows, monkeypatch):
    from vereda.operators import stats

    monkeypatch.setattr(stats.range_slices, "__defaults__", (2, False))
    df = spark.createDataFrame([("a", i, 0 if i in (4, 5) else 1) for i in range(1, 10)], "company string, page_num int, n_reviews int")
    assert [r[1] for r in rows(ex.crawl_cutoff(df), "page_num")] == [1, 2, 3, 4, 5]


def counted_ngrams(rows, k):
    """Top n-grams per language and size, ties by term, by hand."""
    import re
    from collections import Counter

    counts = {}
    for lang, text in rows:
        words = [w for w in re.findall(r"\w+", (text or "").lower()) if len(w) >= 2]
        for n in (2, 3):
            counts.setdefault((lang, n), Counter()).update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    return sorted((lang, n, t, c, i + 1) for (lang, n), found in counts.items() for i, (t, c) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k]))


@pytest.mark.parametrize("words_first", [2, 6, 1000])
def test_ngrams_by_frequent_words(spark, words_first):
    r = random.Random(4)
    words = ["uno", "dos", "tres", "ñandú", "x", "it's", "q9"] + [f"rare{i}" for i in range(60)]
    rows = [(r.choice(["en", "es", "fr"]), " ".join(r.choices(words, weights=[30, 25, 20, 15, 9, 9, 9] + [1] * 60, k=25))) for _ in range(60)] + [("en", None), ("es", "")]
    df = spark.createDataFrame(rows, "lang string, text string").where("lang in ('en', 'es')")
    got = tt.top_sized_ngrams(df, tx.word_tokens(F.col("text")), ["lang"], [2, 3], 5, words_first)
    assert sorted(tuple(x) for x in got.select("lang", "size", "term", "n", "rank").collect()) == counted_ngrams([x for x in rows if x[0] != "fr"], 5)


@pytest.mark.parametrize("most", [3, 12, 500])
def test_vocabulary_by_frequent_words(spark, most):
    r = random.Random(6)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(r.choices(words, weights=range(1, 31), k=20))) for i in range(40)] + [(90, None), (91, "")]
    df = spark.createDataFrame(rows, "id int, text string")
    counts = {}
    for _, t in rows:
        w = (t or "").split()
        for g in w + [f"{a} {b}" for a, b in zip(w, w[1:])]:
            counts[g] = counts.get(g, 0) + 1
    want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most]
    vocabulary, weights = tf.fit_transform(df, "id", "text", max_features=most)
    assert sorted((x["term"], x["tf"]) for x in vocabulary.collect()) == sorted(want)
    plain = tf.tfidf(df, "id", "text", tf.fit_vocabulary(df, "text", max_features=most))
    rounded = lambda t: sorted((x["id"], x["term"], x["tf"], round(x["weight"], 9)) for x in t.collect())
    assert rounded(weights) == rounded(plain)
    # what is shuffled are terms that the vocabulary knows, never the words of a text
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert not any("text#" in line.split("ENSURE")[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "tokens#" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
