"""Text queries on documents, conversations and pages."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from bindings.common import Catalog, r6, table
from vereda.functions import text as tx
from vereda.operators import evaluation as ev, extract as ex, language as lg, lexicon as lx, text as tt, tfidf as tf
from vereda.plans import reviews
from vereda.session import materialize

catalog = Catalog()

CLEAN = (
    "trim(regexp_replace(regexp_replace(regexp_replace(lower(text), 'http\\S+|www\\.\\S+', ' ', 'g'),"
    " '[^a-záéíóúñü\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
)
WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')"
SPACE_TOKENS = "list_filter(regexp_split_to_array({0}, '\\s+'), lambda t: t <> '')"


def docs(spark, sf):
    return table(spark, sf, "documents")


@catalog.add(
    f"select doc_id, {CLEAN} as clean_text, cast(len({SPACE_TOKENS.format(CLEAN)}) as integer) as text_length from documents"
)
def clean_text(spark, sf):
    out = docs(spark, sf).select("doc_id", tx.clean_text(F.col("text")).alias("clean_text"))
    return out.withColumn("text_length", tx.text_length(F.col("clean_text")))


@catalog.add(
    "select doc_id, contains(text, 'the') or contains(text, 'que') as has_marker,"
    " md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) as stripped from documents"
)
def text_markers(spark, sf):
    return docs(spark, sf).select(
        "doc_id", tx.contains_any(F.col("text"), ["the", "que"]).alias("has_marker"),
        F.md5(tx.strip(F.col("text"))).alias("stripped"),
    )


@catalog.add("""
select conv_id, turn, role as segment_label, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as raw_text
from conversations where role in ('user', 'assistant', 'system') and regexp_matches(text, '\\S')
""")
def segments_unpivot(spark, sf):
    roles = ["user", "assistant", "system"]
    turns = table(spark, sf, "conversations").select(
        "conv_id", "turn", *[F.when(F.col("role") == r, F.col("text")).alias(r) for r in roles]
    )
    return tt.unpivot_segments(turns, ["conv_id", "turn"], roles)


def gram_sql(n: int) -> str:
    """grams(doc_id, lang, term): n-grams of two-letter-plus words."""
    ahead = "".join(f" || ' ' || lead(token, {i}) over doc" for i in range(1, n))
    return (
        f"words as (select doc_id, lang, {WORDS} as w from documents),"
        " tokens as (select doc_id, lang, unnest(w) as token, generate_subscripts(w, 1) as pos from words),"
        f" grams as (select * from (select doc_id, lang, token{ahead} as term from tokens"
        " window doc as (partition by doc_id order by pos)) where term is not null)"
    )


def top_sql(n: int) -> str:
    return f"with {gram_sql(n)} select term, count(*) as n from grams group by term order by n desc, term limit 15"


@catalog.add(top_sql(2))
def top_bigrams(spark, sf):
    return tt.top_ngrams(docs(spark, sf), "text", 2, 2)


@catalog.add(top_sql(3))
def top_trigrams(spark, sf):
    return tt.top_ngrams(docs(spark, sf), "text", 3, 3)


@catalog.add(f"""
with both_sizes as (
  select lang, 2 as size, term from (with {gram_sql(2)} select lang, term from grams)
  union all select lang, 3, term from (with {gram_sql(3)} select lang, term from grams)),
counts as (select lang, size, term, count(*) as n from both_sizes where lang in ('en', 'es') group by all)
select lang, size, term, n, cast(row_number() over (partition by lang, size order by n desc, term) as integer) as rank
from counts qualify rank <= 15
""")
def ngram_summary(spark, sf):
    return tt.ngram_summary(docs(spark, sf), "text", "lang", ["en", "es"])


@catalog.add(f"""
with tokens as (select lang, unnest({SPACE_TOKENS.format(CLEAN)}) as term from documents),
counts as (select lang, term, count(*) as n from tokens group by all)
select lang, term, n, cast(row_number() over (partition by lang order by n desc, term) as integer) as rank
from counts qualify rank <= 20
""")
def token_frequency(spark, sf):
    cleaned = docs(spark, sf).select("lang", tx.clean_text(F.col("text")).alias("clean_text"))
    return tt.token_frequency(cleaned, "clean_text", ["lang"])


@catalog.add(f"""
with labelled as (select quality, {WORDS} as w from documents join labels using (doc_id)),
terms as (select quality, unnest(w) as term from labelled),
counts as (select quality, term, count(*) as n from terms group by all),
totals as (select quality, count(*) as total from terms group by all)
select quality, term, n, total, cast(row_number() over (partition by quality order by n desc, term) as integer) as rank,
       round(n / total, 6) as share
from counts join totals using (quality) qualify rank <= 15
""")
def ngram_share_by_label(spark, sf):
    labelled = docs(spark, sf).select("doc_id", "text").join(
        table(spark, sf, "labels").select("doc_id", "quality"), "doc_id"
    )
    out = tt.ngram_share(labelled, "text", "quality")
    return out.select("quality", "term", "n", "total", "rank", r6("share").alias("share"))


VOCABULARY_SQL = f"""
with grams as (
  select doc_id, term from (with {gram_sql(1)} select doc_id, term from grams)
  union all select doc_id, term from (with {gram_sql(2)} select doc_id, term from grams)),
tf as (select doc_id, term, count(*) as tf from grams group by all),
vocabulary as (select term, cast(sum(tf) as bigint) as tf, count(*) as df,
    ln((1 + (select count(*) from documents)) / (1 + count(*))) + 1 as idf
  from tf group by term order by sum(tf) desc, term limit 5000)
"""


@catalog.add(VOCABULARY_SQL + "select term, tf, df, round(idf, 6) as idf from vocabulary")
def tfidf_vocabulary(spark, sf):
    return tf.fit_vocabulary(docs(spark, sf), "text").select("term", "tf", "df", r6("idf").alias("idf"))


@catalog.add(
    VOCABULARY_SQL
    + ", raw as (select doc_id, term, t.tf, t.tf * idf as x from tf t join vocabulary using (term))"
    + " select doc_id, term, tf, round(x / sqrt(sum(x * x) over (partition by doc_id)), 6) as weight from raw"
)
def tfidf_weights(spark, sf):
    _, out = tf.fit_transform(docs(spark, sf), "doc_id", "text")
    return out.select("doc_id", "term", "tf", r6("weight").alias("weight"))


CLEAN_TOKENS_SQL = f"""
with clean as (select doc_id, lang, {CLEAN} as c from documents),
tokens as (select doc_id, lang, unnest(t) as token, generate_subscripts(t, 1) as pos
  from (select doc_id, lang, {SPACE_TOKENS.format('c')} as t from clean)),
stop as (select lang, token from (select lang, token, count(*) as n from tokens group by all)
  qualify row_number() over (partition by lang order by n desc, token) <= 20)
"""


def stop_and_lemma(cleaned):
    """Dictionaries learned from the texts: the 20 most frequent words of each
    language, and words without their plural ending."""
    counts = materialize(tt.term_counts(cleaned, tx.space_tokens(F.col("clean_text")), ["lang"]), "words")
    stop = tt.top_terms(counts, ["lang"], 20).select("lang", F.col("term").alias("token"))
    lemma = counts.where(F.col("term").rlike("^.{4,}s$")).select(
        "lang", F.col("term").alias("token"), F.regexp_replace("term", "(es|s)$", "").alias("lemma")
    )
    return materialize(stop, "stop"), materialize(lemma, "lemma")


@catalog.add(
    CLEAN_TOKENS_SQL
    + """, kept as (select doc_id, pos, case when regexp_matches(token, '^.{4,}s$') then regexp_replace(token, '(es|s)$', '') else token end as l
    from tokens anti join stop using (lang, token)),
    joined as (select doc_id, string_agg(l, ' ' order by pos) as t from kept group by doc_id)
    select doc_id, case when lang in ('en', 'es') then coalesce(t, '') else c end as lemma_text from clean left join joined using (doc_id)"""
)
def lemma_text(spark, sf):
    cleaned = materialize(
        docs(spark, sf).select("doc_id", "lang", tx.clean_text(F.col("text")).alias("clean_text")), "clean"
    )
    stop, lemma = stop_and_lemma(cleaned)
    return lx.lemmatize(cleaned, "doc_id", "clean_text", "lang", stop, lemma).select("doc_id", "lemma_text")


# Word lists for the sentiment queries come from the words themselves: the
# digest of a word decides whether it is scored, negates, boosts or does nothing.
SENTIMENT_SQL = f"""
with words as (select doc_id, lang, {WORDS} as w from documents where lang = 'en'),
tokens as (select doc_id, unnest(w) as token, generate_subscripts(w, 1) as pos from words),
vocab as (select distinct token, md5(token) as h from tokens),
valence as (select token, (instr('0123456789abcdef', substr(h, 1, 1)) - 8.5) * 0.4 as valence from vocab where substr(h, 2, 1) in ('0','1','2','3')),
modifiers as (select token, case when substr(h, 2, 1) = '4' then 'negation' else 'booster' end as kind,
  case substr(h, 2, 1) when '5' then 0.293 when '6' then -0.293 else 0.0 end as delta from vocab where substr(h, 2, 1) in ('4','5','6')),
near as (select doc_id, token, lag(token, 1) over w as p1, lag(token, 2) over w as p2, lag(token, 3) over w as p3 from tokens window w as (partition by doc_id order by pos)),
scored as (select doc_id, valence,
  coalesce(case when m1.kind = 'booster' then m1.delta end, 0) * 1.0 + coalesce(case when m2.kind = 'booster' then m2.delta end, 0) * 0.95
   + coalesce(case when m3.kind = 'booster' then m3.delta end, 0) * 0.9 as boost,
  coalesce(m1.kind = 'negation', false) or coalesce(m2.kind = 'negation', false) or coalesce(m3.kind = 'negation', false) as negated
  from near join valence using (token) left join modifiers m1 on m1.token = p1 left join modifiers m2 on m2.token = p2 left join modifiers m3 on m3.token = p3),
sums as (select doc_id, sum((valence + sign(valence) * boost) * case when negated then -0.74 else 1.0 end) as s from scored group by doc_id),
result as (select documents.doc_id, lang, case when lang = 'en' then coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15) end as compound
  from documents left join sums using (doc_id)),
labelled as (select doc_id, round(compound, 6) + 0.0 as lexicon_compound,
  case when compound is null then 'not_applicable' when compound >= 0.05 then 'positive' when compound <= -0.05 then 'negative' else 'neutral' end as lexicon_label from result)
"""


def word_lists(d):
    words = d.where("lang = 'en'").select(F.explode(tx.word_tokens(F.col("text"))).alias("token")).distinct()
    first, second = F.substring(F.md5("token"), 1, 1), F.substring(F.md5("token"), 2, 1)
    valence = words.where(second.isin("0", "1", "2", "3")).select(
        "token", ((F.instr(F.lit("0123456789abcdef"), first) - 8.5) * 0.4).cast("double").alias("valence")
    )
    modifiers = words.where(second.isin("4", "5", "6")).select(
        "token",
        F.when(second == "4", "negation").otherwise("booster").alias("kind"),
        F.when(second == "5", 0.293).when(second == "6", -0.293).otherwise(0.0).alias("delta"),
    )
    return materialize(valence, "valence"), materialize(modifiers, "modifiers")


def scored_docs(spark, sf):
    d = docs(spark, sf).select("doc_id", "lang", "text")
    valence, modifiers = word_lists(d)
    return lx.lexicon_sentiment(d, "doc_id", "text", "lang", valence, modifiers)


@catalog.add(SENTIMENT_SQL + "select * from labelled")
def lexicon_sentiment(spark, sf):
    return scored_docs(spark, sf).select("doc_id", r6("lexicon_compound").alias("lexicon_compound"), "lexicon_label")


@catalog.add(SENTIMENT_SQL + "select lexicon_label, count(*) as n from labelled group by all")
def sentiment_counts(spark, sf):
    return tt.sentiment_counts(scored_docs(spark, sf), "lexicon_label")


TRIGRAM_SQL = """
with padded as (select doc_id, lang, ' ' || trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) || ' ' as t from documents),
chars as (select doc_id, lang, unnest(c) as c, generate_subscripts(c, 1) as pos from (select doc_id, lang, string_split(t, '') as c from padded)),
grams as (select * from (select doc_id, lang, c || lead(c, 1) over d || lead(c, 2) over d as gram from chars window d as (partition by doc_id order by pos)) where gram is not null),
counts as (select lang, gram, count(*) as n from grams group by all),
totals as (select lang, sum(n) as total from counts group by lang),
v as (select count(distinct gram) as v from counts),
cells as (select g.gram, t.lang, ln((coalesce(c.n, 0) + 1) / (t.total + v)) as logp
  from (select distinct gram from counts) g cross join totals t cross join v left join counts c on c.gram = g.gram and c.lang = t.lang),
bags as (select doc_id, gram, count(*) as n from grams group by all),
sums as (select doc_id, cells.lang, sum(n * logp) as s from bags join cells using (gram) group by all),
best as (select doc_id, lang from sums qualify row_number() over (partition by doc_id order by s desc, lang) = 1)
"""


@catalog.add(
    TRIGRAM_SQL
    + "select documents.doc_id, case when best.lang in ('en', 'es') then best.lang else 'unknown' end as language"
    " from documents left join best using (doc_id)"
)
def language_tag(spark, sf):
    d = docs(spark, sf).select("doc_id", "text", "lang")
    profiles = lg.learn_profiles(d, "text", "lang")
    return lg.language_tag(d, "doc_id", "text", profiles).select("doc_id", "language")


@catalog.add(
    TRIGRAM_SQL
    + f""", tagged as (select documents.doc_id, documents.lang, case when best.lang in ('en', 'es') then best.lang else 'unknown' end as language,
      {CLEAN} as c from documents left join best using (doc_id)),
    split as (select *, {SPACE_TOKENS.format('c')} as w from tagged),
    tokens as (select doc_id, lang, language, unnest(w) as token, generate_subscripts(w, 1) as pos from split),
    word_counts as (select lang, token, count(*) as n from tokens group by all),
    stop as (select lang, token from word_counts qualify row_number() over (partition by lang order by n desc, token) <= 20),
    kept as (select t.doc_id, t.pos, case when w.token is not null and regexp_matches(t.token, '^.{{4,}}s$') then regexp_replace(t.token, '(es|s)$', '') else t.token end as l
      from tokens t left join stop on stop.lang = t.language and stop.token = t.token
      left join word_counts w on w.lang = t.language and w.token = t.token
      where t.language <> 'unknown' and stop.token is null),
    joined as (select doc_id, string_agg(l, ' ' order by pos) as t, count(*) as n from kept group by doc_id)
    select doc_id, language, md5(case when language = 'unknown' then c else coalesce(t, '') end) as lemma_md5,
      cast(case when language = 'unknown' then len(w) else coalesce(n, 0) end as integer) as text_length
    from split left join joined using (doc_id)"""
)
def segment_preparation(spark, sf):
    d = docs(spark, sf).select("doc_id", "text", "lang")
    profiles = lg.learn_profiles(d, "text", "lang")
    cleaned = materialize(d.select("doc_id", "lang", tx.clean_text(F.col("text")).alias("clean_text")), "clean")
    stop, lemma = stop_and_lemma(cleaned)
    out = tt.prepare_segments(d.select("doc_id", "text"), profiles, stop, lemma, "doc_id", "text")
    return out.select("doc_id", "language", F.md5("lemma_text").alias("lemma_md5"), "text_length")


PAGE_TEXT = "trim(regexp_replace({unescaped}, '\\s+', ' ', 'g'))"


def _unescaped_sql(expr: str) -> str:
    for entity, text in tx.HTML_ENTITIES:
        expr = "replace({}, '{}', '{}')".format(expr, entity, text.replace("'", "''"))
    return expr


def _inner_sql(expr: str) -> str:
    return PAGE_TEXT.format(unescaped=_unescaped_sql(f"regexp_replace({expr}, '<[^>]*>', ' ', 'g')"))


@catalog.add(f"""
with bare as (select page_id, url, regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', '', 'g') as h from pages),
blocks as (select page_id, url, unnest(regexp_extract_all(h, '(?is)<article\\b.*?</article>')) as a from bare),
parts as (select page_id, url, {_inner_sql("regexp_extract(a, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)")} as review_title,
  regexp_split_to_array(a, '(?i)<p\\b[^>]*>') as p from blocks)
select page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) as company, review_title,
  {_inner_sql("regexp_replace(p[2], '(?is)</p>.*', '')")} as first_text,
  {_inner_sql("regexp_replace(p[3], '(?is)</p>.*', '')")} as second_text,
  cast(len(p) - 1 as integer) as n_texts
from parts where review_title <> ''
""")
def extract_articles(spark, sf):
    blocks = ex.articles(table(spark, sf, "pages"))
    texts = blocks.select(
        "page_id", F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("company"),
        ex.article_title(F.col("article")).alias("review_title"), ex.paragraphs(F.col("article")).alias("p"),
    )
    return texts.where(F.col("review_title") != "").select(
        "page_id", "company", "review_title",
        F.get("p", F.lit(0)).alias("first_text"), F.get("p", F.lit(1)).alias("second_text"),
        F.size("p").alias("n_texts"),
    )


@catalog.add(f"""
with blocks as (select page_id, unnest(regexp_extract_all(html, '(?is)<article\\b.*?</article>')) as a from pages)
select page_id, {_inner_sql("regexp_extract(a, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)")} as review_title, '' as pros, '' as cons
from blocks where contains(a, '<h1')
""")
def extract_reviews(spark, sf):
    """The pages hold no pros or cons markers, so both texts stay empty."""
    return ex.extract_reviews(table(spark, sf, "pages")).select("page_id", "review_title", "pros", "cons")


REVIEW_TEXT = "trim(regexp_replace(regexp_replace(lower(substr(text, 1, 200)), '[^a-z ]', ' ', 'g'), ' +', ' ', 'g'))"


@catalog.add(f"""
with t as (select doc_id, lang, source, {REVIEW_TEXT} as c from documents)
select doc_id, 'Review ' || doc_id as review_title, c as pros, case when doc_id % 3 = 0 then '' else source || ' & ' || lang end as cons from t
""")
def marked_reviews(spark, sf):
    """Reviews out of pages made of the documents: markers of two languages, entities,
    a script, text that only resembles a marker, and articles without a cons part."""
    text = tx.collapse_spaces(F.regexp_replace(F.lower(F.substring("text", 1, 200)), "[^a-z ]", " "))
    es = F.col("lang") == "es"
    page = F.concat(
        F.lit("<html><script>var a = '<article><h3>no</h3></article>';</script><article><h3>Review&nbsp;"), F.col("doc_id"),
        F.lit("</h3><p>Consejos</p><p>none</p><p class='m'>"), F.when(es, "Ventajas").otherwise("Pros"), F.lit("</p><p><b>"), text, F.lit("</b></p>"),
        F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("<p>"), F.when(es, "Desventajas").otherwise("Cons"), F.lit("</p><p>"), "source", F.lit(" &amp; "), "lang", F.lit("</p>"))),
        F.lit("</article><article><p>Pros</p><p>untitled</p></article></html>"),
    )
    pages = docs(spark, sf).select("doc_id", page.alias("html"))
    return ex.extract_reviews(pages).select("doc_id", "review_title", "pros", "cons")


@catalog.add(
    TRIGRAM_SQL
    + """, tagged as (select documents.doc_id, case when best.lang in ('en', 'es') then best.lang else 'unknown' end as language,
      case when documents.doc_id % 2 = 0 then 'pros' else 'cons' end as label from documents left join best using (doc_id))
    select 'language' as kind, language as value, count(*) as n from tagged group by language
    union all select 'label', label, count(*) from tagged group by label
    union all select 'lexicon', 'not_installed', count(*) from documents
    union all select 'model', 'not_installed', count(*) from documents"""
)
def review_job(spark, sf):
    """The whole text job on reviews made of the documents: the counts that it reports."""
    d = docs(spark, sf)
    even = F.col("doc_id") % 2 == 0
    given = d.select(
        F.col("source").alias("company"), F.col("doc_id").cast("string").alias("review_title"),
        F.when(even, F.col("text")).alias("pros"), F.when(~even, F.col("text")).alias("cons"),
    )
    cleaned = materialize(d.select("doc_id", "lang", tx.clean_text(F.col("text")).alias("clean_text")), "clean")
    stop, lemma = stop_and_lemma(cleaned)
    done = reviews.run(given, lg.learn_profiles(d, "text", "lang"), stop, lemma)
    counts = [("language", done.language_counts, "language"), ("label", done.label_counts, "segment_label"), ("lexicon", done.lexicon_counts, "lexicon_label"), ("model", done.model_counts, "model_label")]
    parts = [df.select(F.lit(kind).alias("kind"), F.col(c).alias("value"), "n") for kind, df, c in counts]
    return ev.union_all(parts)


@catalog.add(f"select page_id, md5({_unescaped_sql('html')}) as unescaped from pages")
def html_entities(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(tx.unescape_html(F.col("html"))).alias("unescaped"))


@catalog.add("""
select page_id, cast(n as integer) as page_number,
  case when n = 1 then url else
    regexp_replace(regexp_extract(url, '^([^?#]*)', 1), '\\.html?$', '') || '_IP' || n ||
    case when regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '(\\.html?)$', 1) = '' then '.htm'
         else regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '(\\.html?)$', 1) end ||
    substr(url, length(regexp_extract(url, '^([^?#]*)', 1)) + 1) end as page_url
from pages, range(1, 6) r(n)
""")
def page_urls(spark, sf):
    return ex.page_urls(table(spark, sf, "pages").select("page_id", "url"), "url", 5).select(
        "page_id", "page_number", "page_url"
    )


@catalog.add("""
with r as (select user_id as company, event_id as page_num, case when event_type in ('error', 'signup') then 0 else 1 end as n_reviews from events),
marked as (select *, lag(n_reviews) over (partition by company order by page_num) as prev from r),
stops as (select company, min(page_num) as stop from marked where n_reviews = 0 and prev = 0 group by company)
select r.company, page_num, cast(n_reviews as integer) as n_reviews from r left join stops using (company) where stop is null or page_num <= stop
""")
def crawl_cutoff(spark, sf):
    pages = table(spark, sf, "events").select(
        F.col("user_id").alias("company"), F.col("event_id").alias("page_num"),
        F.when(F.col("event_type").isin("error", "signup"), 0).otherwise(1).alias("n_reviews"),
    )
    return ex.crawl_cutoff(pages)
