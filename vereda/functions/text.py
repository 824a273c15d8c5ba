"""Column expressions over text and token arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: characters kept by text cleaning, and the URL pattern
KEPT_LETTERS = "a-záéíóúñü"
URL_PATTERN = r"http\S+|www\.\S+"

# fixed values: named HTML entities and the text they stand for; the
# ampersand comes last so that "&amp;lt;" does not become "<"
HTML_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&middot;", "·"),
    ("&copy;", "©"),
    ("&aacute;", "á"),
    ("&eacute;", "é"),
    ("&iacute;", "í"),
    ("&oacute;", "ó"),
    ("&uacute;", "ú"),
    ("&ntilde;", "ñ"),
    ("&amp;", "&"),
]


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row.

    An expression used inside a lambda is otherwise computed for every element
    the lambda visits, which is quadratic for arrays made from a text.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only the space character."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | ~c.rlike(r"(?U)\S")


def drop_urls(c: Column) -> Column:
    return F.regexp_replace(c, URL_PATTERN, " ")


def keep_letters(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)[^{KEPT_LETTERS}\s]", " ")


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def clean_text(c: Column) -> Column:
    """Lower case, no URLs, only English and Spanish letters, single spaces."""
    return collapse_spaces(keep_letters(drop_urls(F.lower(F.coalesce(c, F.lit(""))))))


def space_tokens(c: Column) -> Column:
    """White-space tokens; blank or missing text has none."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda t: t != "")


def text_length(c: Column) -> Column:
    return F.size(space_tokens(c))


def word_tokens(c: Column) -> Column:
    """Lower-cased words of two or more letters, digits or underscores. Cutting at
    what is no word costs half of matching the words."""
    parts = F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}_]+")
    return F.filter(parts, lambda t: F.length(t) >= 2)


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of ``n`` consecutive tokens of one document."""
    if n == 1:
        return tokens

    def runs(t):
        m = F.greatest(F.size(t) - (n - 1), F.lit(0))
        out = F.slice(t, 1, m)
        for k in range(2, n + 1):
            out = F.zip_with(out, F.slice(t, k, m), lambda a, b: F.concat(a, F.lit(" "), b))
        return out

    return bind(tokens, runs)


def ngram_range(tokens: Column, low: int, high: int) -> Column:
    return bind(tokens, lambda t: F.concat(*[ngrams(t, n) for n in range(low, high + 1)]))


def join_nonempty(tokens: Column) -> Column:
    return F.array_join(F.filter(tokens, lambda t: t.isNotNull() & (t != "")), " ")


def contains_any(c: Column, needles: list[str]) -> Column:
    hit = F.lit(False)
    for needle in needles:
        hit = hit | c.contains(needle)
    return hit


def unescape_html(c: Column) -> Column:
    for entity, text in HTML_ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(text))
    return c


def page_url(url: Column, page: Column) -> Column:
    """URL of a result page: page 1 is the URL itself, page n puts ``_IPn``
    before the ``.htm``/``.html`` ending of the path and keeps the query.
    A path without that ending gets ``_IPn.htm``."""
    path = F.regexp_extract(url, r"^([^?#]*)", 1)
    tail = F.substring(url, F.length(path) + 1, F.length(url))
    stem = F.regexp_replace(path, r"\.html?$", "")
    ending = F.regexp_extract(path, r"(\.html?)$", 1)
    ending = F.when(ending == "", ".htm").otherwise(ending)
    return F.when(page == 1, url).otherwise(
        F.concat(stem, F.lit("_IP"), page.cast("string"), ending, tail)
    )


def trigrams(c: Column) -> Column:
    """Character trigrams of the lower-cased text with white space collapsed
    and one space of padding on both sides; empty for blank text."""
    t = F.concat(F.lit(" "), collapse_spaces(F.lower(F.coalesce(c, F.lit("")))), F.lit(" "))
    # every position starts a match; a position inside a surrogate pair does not
    return F.regexp_extract_all(t, F.lit(r"(?s)(?=([^\x{DC00}-\x{DFFF}]..))"), F.lit(1))
