"""Reviews out of stored HTML pages, page lists and the crawl stop rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vereda.functions import text as tx
from vereda.operators.stats import range_slices

# fixed values: paragraphs that announce the two parts of a review
PROS_MARKERS = ["Pros", "Ventajas"]
CONS_MARKERS = ["Cons", "Desventajas"]


def strip_code(html: Column) -> Column:
    """Without scripts, styles and comments."""
    return F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", "")


def inner_text(html: Column) -> Column:
    return tx.strip(tx.collapse_spaces(tx.unescape_html(F.regexp_replace(html, r"(?s)<[^>]*>", " "))))


def articles(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per article element: (..., article_no, article)."""
    blocks = F.regexp_extract_all(strip_code(F.col(html)), F.lit(r"(?is)<article\b.*?</article>"), F.lit(0))
    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep, F.posexplode(blocks).alias("article_no", "article"))


def article_title(article: Column) -> Column:
    """First h3, else an element marked as title, else h1; empty if none."""
    patterns = [
        r"(?is)<h3\b[^>]*>(.*?)</h3>",
        r"""(?is)<[a-z0-9]+\b[^>]*data-test=["'][^"']*title[^"']*["'][^>]*>(.*?)</""",
        r"(?is)<h1\b[^>]*>(.*?)</h1>",
    ]
    found = [inner_text(F.regexp_extract(article, p, 1)) for p in patterns]
    return F.coalesce(*[F.when(t != "", t) for t in found], F.lit(""))


def paragraphs(article: Column) -> Column:
    """Texts of the p elements in order; an unclosed one ends at the next."""
    opened = F.split(article, r"(?i)<p\b[^>]*>")
    pieces = F.slice(opened, F.lit(2), F.size(opened))
    return F.transform(pieces, lambda p: inner_text(F.regexp_replace(p, r"(?is)</p>.*", "")))


def after_marker(texts: Column, markers: list[str]) -> Column:
    """The paragraph after the last one that is exactly a marker, else ''.
    An exact match keeps "Consejos" from passing for "Cons"."""
    follows = tx.bind(
        texts,
        lambda all_texts: F.transform(
            all_texts,
            lambda t, i: F.when(t.isin(*markers) & (i + 1 < F.size(all_texts)), F.get(all_texts, i + 1)),
        ),
    )
    hits = F.filter(follows, lambda t: t.isNotNull())
    return F.coalesce(F.try_element_at(hits, F.lit(-1)), F.lit(""))


def extract_reviews(pages: DataFrame, html: str = "html") -> DataFrame:
    """Titled articles with the texts after their pros and cons markers.
    A whole page is one row; nothing is shuffled."""
    found = articles(pages, html).select(
        *[c for c in pages.columns if c != html], "article_no",
        article_title(F.col("article")).alias("review_title"),
        paragraphs(F.col("article")).alias("_texts"),
    )
    return found.where(F.col("review_title") != "").select(
        *[c for c in found.columns if c != "_texts"],
        after_marker(F.col("_texts"), PROS_MARKERS).alias("pros"),
        after_marker(F.col("_texts"), CONS_MARKERS).alias("cons"),
    )


def page_urls(targets: DataFrame, url: str = "url", pages: int = 500) -> DataFrame:
    """One row per target and page number with the page's URL."""
    listed = targets.withColumn("page_number", F.explode(F.sequence(F.lit(1), F.lit(pages))))
    return listed.withColumn("page_url", tx.page_url(F.col(url), F.col("page_number")))


def crawl_cutoff(results: DataFrame, key: str = "company", page: str = "page_num", n: str = "n_reviews") -> DataFrame:
    """Pages visited before the crawl of a key stops: everything up to and
    including the second of two consecutive empty pages. ``page`` numbers are
    unique within a key.

    A page is a stop when it and the page before it are empty. Pages are cut
    into ranges by number, so that a key with most of the pages is handled by
    many tasks: each range knows its own stops, and the last page of a range is
    handed to the next one that has pages of the same key. ``results`` is a stored
    table; it is written once, in ranges, and everything else reads these.
    """
    cut = range_slices(results, [page, key], "_slice", stored=True)
    w = W.partitionBy(key, "_slice").orderBy(page)
    seen = cut.withColumn("_prev", F.lag(n).over(w))
    edges = cut.groupBy(key, "_slice").agg(F.max_by(n, page).alias("_last"))
    edges = edges.select(
        F.col(key).alias("_k"), F.col("_slice").alias("_s"),
        F.lag("_last").over(W.partitionBy(key).orderBy("_slice")).alias("_carry"),
    )
    joined = seen.join(edges, (F.col(key).eqNullSafe(F.col("_k"))) & (F.col("_slice") == F.col("_s")))
    stop_here = (F.col(n) == 0) & (F.coalesce(F.col("_prev"), F.col("_carry")) == 0)
    stops = joined.where(stop_here).groupBy(F.col(key).alias("_k")).agg(F.min(page).alias("_stop"))
    return (
        cut.join(stops, F.col(key).eqNullSafe(F.col("_k")), "left")
        .where(F.col("_stop").isNull() | (F.col(page) <= F.col("_stop")))
        .drop("_k", "_stop", "_slice")
    )
