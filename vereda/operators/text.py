"""Review segments, n-gram and token counts, text preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vereda.functions import text as tx
from vereda.operators.quality import require_columns, require_rows
from vereda.session import materialize

# fixed values: the columns a review and a segment carry
REVIEW_REQUIRED = ["company", "review_title", "pros", "cons"]
SEGMENT_KEEPS = {
    "company": "string",
    "review_title": "string",
    "rating": "double",
    "review_date": "string",
    "source_url": "string",
    "page_number": "int",
}


def review_columns(df: DataFrame) -> DataFrame:
    """Accept ``title`` for ``review_title`` and check the required columns."""
    if "review_title" not in df.columns and "title" in df.columns:
        df = df.withColumnRenamed("title", "review_title")
    return require_columns(df, REVIEW_REQUIRED, "required review columns")


def unpivot_segments(
    df: DataFrame, ids: list[str], parts: list[str], label: str = "segment_label", text: str = "raw_text"
) -> DataFrame:
    """One row per non-blank text column. Missing text yields no row; it does
    not turn into the word "nan"."""
    long = df.unpivot(ids, parts, label, text)
    return long.withColumn(text, tx.strip(F.col(text))).where(F.col(text) != "")


def expand_reviews(df: DataFrame) -> DataFrame:
    """Reviews to pros/cons segments; absent optional columns become nulls."""
    df = review_columns(df)
    for name, kind in SEGMENT_KEEPS.items():
        column = F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)
        df = df.withColumn(name, column)
    out = unpivot_segments(df, list(SEGMENT_KEEPS), ["pros", "cons"])
    return require_rows(out, "no review holds any pros or cons")


def term_counts(df: DataFrame, terms: Column, keys: list[str]) -> DataFrame:
    """Frequency of array elements per key. Terms are counted inside each task
    before the shuffle, so a term or key with most rows is no hot spot."""
    return (
        df.select(*keys, F.explode(terms).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count("*").alias("n"))
    )


def top_terms(counts: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` most frequent terms, ties in term order, per key.

    With keys, Spark keeps only k rows per key in each task before the shuffle.
    """
    if not keys:
        return counts.orderBy(F.desc("n"), "term").limit(k)
    w = W.partitionBy(*keys).orderBy(F.desc("n"), "term")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def frequent_words(words: DataFrame, keys: list[str], most: int) -> tuple[set[str], dict[tuple, int]]:
    """The ``most`` most frequent words per key of ``words`` (keys, term, n), and per key
    the largest count of a word that is not among them (0 if all are). ``keys`` have
    few values."""
    rows = top_terms(words, keys, most + 1).collect()
    by_key: dict[tuple, list] = {}
    for r in rows:
        by_key.setdefault(tuple(r[k] for k in keys), []).append((-r["n"], r["term"]))
    kept = {t for found in by_key.values() for _, t in sorted(found)[:most]}
    left = {key: max((-n for n, t in found if t not in kept), default=0) for key, found in by_key.items()}
    return kept, left


def known_words(tokens: str, words: set[str]) -> Column:
    """The column's tokens with NULL for those that are not in ``words``; a hash set
    decides. ``words`` are ``word_tokens``, so they need no quoting."""
    names = ", ".join(f"'{w}'" for w in sorted(words))
    return F.expr(f"transform({tokens}, t -> if(t in ({names}), t, cast(null as string)))")


#: words whose n-grams are counted first
WORDS_FIRST = 1000


def ngram_counts(df: DataFrame, tokens: Column, keys: list[str], sizes: list[int]) -> DataFrame:
    """(keys, size, term, n): n-grams without NULL tokens."""

    def sized(t, size):
        whole = F.filter(tx.ngrams(t, size), lambda g: g.isNotNull())
        return F.transform(whole, lambda g: F.struct(F.lit(size).alias("size"), g.alias("term")))

    tagged = tx.bind(tokens, lambda t: F.concat(*[sized(t, size) for size in sizes]))
    counted = df.select(*keys, F.explode(tagged).alias("g"))
    return counted.groupBy(*keys, "g.size", "g.term").agg(F.count("*").alias("n"))


def top_sized_ngrams(df: DataFrame, tokens: Column, keys: list[str], sizes: list[int], k: int, words_first: int = WORDS_FIRST) -> DataFrame:
    """(keys, size, term, n, rank): the top ``k`` n-grams per key and size; ``keys`` have few values.

    An n-gram is no more frequent than its rarest word. So words are counted first,
    and then the n-grams of the most frequent words only. If each key and size has
    ``k`` of them that are more frequent than any word left out, nothing else can be
    among the top; else all n-grams are counted.
    """
    words, left = frequent_words(term_counts(df, tokens, keys), keys, words_first)
    if words:
        few = df.select(*keys, tokens.alias("_tokens")).select(*keys, known_words("_tokens", words).alias("_tokens"))
        found = materialize(top_terms(ngram_counts(few, F.col("_tokens"), keys, sizes), [*keys, "size"], k), "ngrams")
        cuts = {(tuple(r[c] for c in keys), r["size"]): r["n"] for r in found.where(F.col("rank") == k).collect()}
        # a key whose words are all among the counted ones is done, however few n-grams it has
        if all(n == 0 or cuts.get((key, size), 0) > n for key, n in left.items() for size in sizes):
            return found
    return top_terms(ngram_counts(df, tokens, keys, sizes), [*keys, "size"], k)


def top_ngrams(df: DataFrame, text: str, low: int = 2, high: int = 2, k: int = 15) -> DataFrame:
    """(term, n) over the whole column; words of two or more characters."""
    tokens = tx.word_tokens(F.col(text))
    if low == high:
        return top_sized_ngrams(df, tokens, [], [low], k).select("term", "n")
    return top_terms(term_counts(df, tx.ngram_range(tokens, low, high), []), [], k)


def ngram_summary(
    df: DataFrame, text: str, lang: str, langs: list[str], sizes: list[int] = [2, 3], k: int = 15
) -> DataFrame:
    """(lang, size, term, n, rank): the top n-grams of every size and language."""
    chosen = df.where(F.col(lang).isin(*langs)).withColumn("lang", F.col(lang))
    return top_sized_ngrams(chosen, tx.word_tokens(F.col(text)), ["lang"], sizes, k)


def token_frequency(df: DataFrame, text: str, keys: list[str] = [], k: int = 20) -> DataFrame:
    """Top white-space tokens, per key if given."""
    return top_terms(term_counts(df, tx.space_tokens(F.col(text)), keys), keys, k)


def ngram_share(df: DataFrame, text: str, label: str, n: int = 1, k: int = 15) -> DataFrame:
    """Top n-grams per label with their share of the label's n-grams."""
    counts = term_counts(df, tx.ngrams(tx.word_tokens(F.col(text)), n), [label])
    totals = (
        df.groupBy(label).agg(F.sum(F.size(tx.ngrams(tx.word_tokens(F.col(text)), n))).alias("total"))
    )
    top = top_terms(counts, [label], k)
    return top.join(totals, label).withColumn("share", F.try_divide(F.col("n"), F.col("total")))


def prepare_segments(
    df: DataFrame,
    profiles: DataFrame,
    stopwords: DataFrame,
    lemmas: DataFrame,
    id_col: str,
    text: str = "raw_text",
    allowed: tuple[str, ...] = ("en", "es"),
) -> DataFrame:
    """Language, clean text, lemma text and token count for every segment."""
    from vereda.operators.language import language_tag
    from vereda.operators.lexicon import lemmatize

    tagged = language_tag(df, id_col, text, profiles, allowed)
    cleaned = tagged.withColumn("clean_text", tx.clean_text(F.col(text)))
    out = lemmatize(cleaned, id_col, "clean_text", "language", stopwords, lemmas)
    return out.withColumn("text_length", tx.text_length(F.col("lemma_text")))


def sentiment_counts(df: DataFrame, label: str) -> DataFrame:
    """Counts per sentiment label, missing labels as "null", largest first."""
    counts = df.groupBy(F.coalesce(F.col(label), F.lit("null")).alias(label)).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), label)
