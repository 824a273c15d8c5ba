"""Profiles, counts, joins, sources, sinks and run records."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bindings.common import Catalog, r6, table
from vereda.operators import evaluation as ev, quality as q, sampling as sm
from vereda.operators.graph import split_terminals
from vereda.operators.stats import column_facts
from vereda.session import materialize, scratch_path
from vereda.sources import readers, runlog, writers

catalog = Catalog()


def labelled(spark, sf):
    """Documents with their quality label, missing for those without one."""
    labels = table(spark, sf, "labels")
    return table(spark, sf, "documents").join(labels, "doc_id", "left")


@catalog.add("""
with d as (select text, documents.lang as lang, source, n_chars, quality from documents left join labels using (doc_id)),
f as (select count(*) as n, (select count(*) from (select distinct * from d)) as u from d)
select column_name, null_count, n as total_rows, cast(5 as bigint) as total_columns, n - u as duplicate_rows from f, (
  select 'text' as column_name, count(*) - count(text) as null_count from d union all
  select 'lang', count(*) - count(lang) from d union all
  select 'source', count(*) - count(source) from d union all
  select 'n_chars', count(*) - count(n_chars) from d union all
  select 'quality', count(*) - count(quality) from d)
""")
def table_profile(spark, sf):
    return q.table_profile(labelled(spark, sf).select("text", "lang", "source", "n_chars", "quality"))


@catalog.add("""
select count(*) as total_rows, count(distinct (ts, user_id, event_type, value)) as distinct_rows,
  count(*) - count(distinct (ts, user_id, event_type, value)) as duplicate_rows from events
""")
def duplicate_events(spark, sf):
    return q.duplicate_count(table(spark, sf, "events").select("ts", "user_id", "event_type", "value"))


@catalog.add("""
with d as (select text, lang from documents)
select count(*) as total_rows, (select count(*) from (select distinct * from d)) as distinct_rows,
  count(*) - (select count(*) from (select distinct * from d)) as duplicate_rows from d
""")
def duplicate_count(spark, sf):
    return q.duplicate_count(table(spark, sf, "documents").select("text", "lang"))


@catalog.add("select lang, md5(text) as text_md5 from (select distinct text, lang from documents)")
def dedupe_rows(spark, sf):
    out = q.drop_duplicates(table(spark, sf, "documents").select("text", "lang"))
    return out.select("lang", F.md5("text").alias("text_md5"))


@catalog.add("select quality, count(*) as n from documents left join labels using (doc_id) group by quality")
def value_counts(spark, sf):
    return q.value_counts(labelled(spark, sf), "quality")


@catalog.add(
    "select coalesce(cast(toxic as varchar), 'null') as toxic, count(*) as n from documents left join labels using (doc_id) group by 1"
)
def null_label_counts(spark, sf):
    return q.value_counts(labelled(spark, sf), "toxic", null_as="null")


@catalog.add("""
select count(distinct text) as text, count(distinct lang) as lang, count(distinct source) as source,
  count(distinct quality) as quality from documents left join labels using (doc_id)
""")
def distinct_counts(spark, sf):
    return q.distinct_counts(labelled(spark, sf), ["text", "lang", "source", "quality"])


@catalog.add("select doc_id, quality from documents join labels using (doc_id) where quality is not null and regexp_matches(text, '\\S')")
def usable_rows(spark, sf):
    kept = q.drop_blank(q.drop_missing(labelled(spark, sf), ["quality"]), "text")
    return kept.select("doc_id", "quality")


@catalog.add("""
select 'given' as label, doc_id, quality as target from documents left join labels using (doc_id)
union all select 'computed', doc_id, cast(n_chars >= 1500 as integer) from documents
""")
def canonical_label(spark, sf):
    """The label of a table that has one, and of the same table without it."""
    from vereda.functions.numeric import threshold_label
    from vereda.operators.scoring import ensure_label

    given = labelled(spark, sf).select("doc_id", "n_chars", "quality")
    bare = table(spark, sf, "documents").select("doc_id", "n_chars")
    computed = bare.withColumn("target", threshold_label(F.col("n_chars"), F.lit(1500)))
    tables = [("given", ensure_label(given, given, "quality")), ("computed", ensure_label(bare, computed, "quality"))]
    first, second = [t.select(F.lit(name).alias("label"), "doc_id", "target") for name, t in tables]
    return first.union(second)


@catalog.add("""
select cast(event_id as varchar) as id, props as name, event_type as category, value as x, cast(user_id as double) as y
from events where event_type in ('view', 'click') and value is not null
""")
def poi_filter(spark, sf):
    return readers.select_pois(nested_events(spark, sf), ("view", "click"))


def nested_events(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.struct(F.col("props").alias("primary")).alias("names"),
        F.struct(F.col("event_type").alias("primary")).alias("categories"),
        F.col("value").alias("x"), F.col("user_id").cast("double").alias("y"),
    )


@catalog.add("""
select o_orderkey, c_mktsegment, n_name from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
""")
def enrich_left_join(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    with_customer = readers.enrich(orders, customers, "c_custkey")
    return readers.enrich(with_customer, table(spark, sf, "nation"), "n_nationkey").select(
        "o_orderkey", "c_mktsegment", "n_name"
    )


@catalog.add("""
select c_custkey, 'present' as side from customer where c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT')
union all
select c_custkey, 'missing' from customer where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT')
""")
def membership_split(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("node_id"))
    urgent = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("node_id"))
    there, missing = [
        side.select(F.col("node_id").alias("c_custkey"), F.lit(name).alias("side"))
        for side, name in zip(split_terminals(customer, urgent), ("present", "missing"))
    ]
    return there.unionByName(missing)


@catalog.add("""
with refs as (select regexp_extract(url, '^https?://([^/?#]+)', 1) as company, url from pages)
select company, url from refs
""")
def targets_csv(spark, sf):
    """Crawl targets written as CSV and read with their two columns."""
    pages = table(spark, sf, "pages").select(F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("company"), "url")
    path = scratch_path(spark, "targets")
    writers.write_csv(pages, path)
    return readers.read_targets(spark, path)


@catalog.add("""
select source as company, cast(doc_id as varchar) as review_title, text as pros, cast(null as varchar) as cons, null as source_url, n_chars as page_number from documents
""")
def review_file(spark, sf):
    """Reviews through the fixed file format; absent columns come back as NULL."""
    reviews = table(spark, sf, "documents").select(
        F.col("source").alias("company"), F.col("doc_id").cast("string").alias("review_title"), F.col("text").alias("pros"),
        F.lit("").alias("cons"), F.col("n_chars").alias("page_number"), "lang",
    )
    path = scratch_path(spark, "reviews")
    writers.write_reviews(reviews, path)
    return readers.read_csv(spark, path, "company string, review_title string, pros string, cons string, source_url string, page_number long")


@catalog.add("select c_custkey, c_name, c_nationkey from customer")
def table_roundtrip(spark, sf):
    """A catalog table that is replaced and read by name."""
    name = f"vereda_{uuid.uuid4().hex}"
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    path = scratch_path(spark, "catalog")
    writers.replace_table(customers.where("c_nationkey < 5").drop("c_name"), name, path)
    writers.replace_table(customers, name, path)
    return readers.first_nonempty([lambda: readers.load_input(spark, f"table:{name}")])


@catalog.add("select c_custkey, n_regionkey from customer join nation on c_nationkey = n_nationkey where n_regionkey in (0, 1, 2, 3)")
def joined_lists(spark, sf):
    """The customers of four regions, list after list."""
    customers = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    lists = [customers.where(F.col("n_regionkey") == r).select("c_custkey", "n_regionkey") for r in range(4)]
    return ev.union_all(lists)


def outcome(check) -> str:
    try:
        check()
    except ValueError:
        return "refused"
    return "passed"


@catalog.add("""
with l as (select quality, toxic from documents left join labels using (doc_id))
select 'rows' as guard, 'all events' as given, case when count(*) > 0 then 'passed' else 'refused' end as outcome from events
union all select 'rows', 'events of no type', case when count(*) > 0 then 'passed' else 'refused' end from events where event_type = 'absent'
union all select 'columns', 'documents', case when count(*) = 2 then 'passed' else 'refused' end
  from information_schema.columns where table_name = 'documents' and column_name in ('text', 'lang')
union all select 'columns', 'labels', case when count(*) = 2 then 'passed' else 'refused' end
  from information_schema.columns where table_name = 'labels' and column_name in ('quality', 'lang')
union all select 'values', 'labels', case when count(quality) > 0 and count(toxic) > 0 then 'passed' else 'refused' end from l
union all select 'values', 'documents without label', case when count(quality) > 0 and count(toxic) > 0 then 'passed' else 'refused' end from l where quality is null
union all select 'classes', 'labels', case when count(distinct quality) >= 2 then 'passed' else 'refused' end from l
union all select 'classes', 'good documents', case when count(distinct quality) >= 2 then 'passed' else 'refused' end from l where quality = 1
union all select 'classes', 'documents without label', case when count(distinct quality) >= 2 then 'passed' else 'refused' end from l where quality is null
union all select 'features', 'lineitem', case when count(*) >= 4 then 'passed' else 'refused' end from information_schema.columns
  where table_name = 'lineitem' and data_type in ('BIGINT', 'INTEGER', 'DOUBLE') and column_name <> 'l_quantity'
union all select 'features', 'labels', case when count(*) >= 4 then 'passed' else 'refused' end from information_schema.columns
  where table_name = 'labels' and data_type in ('BIGINT', 'INTEGER', 'DOUBLE') and column_name <> 'quality'
union all select 'area key', 'nation', case when count(*) > 0 then 'passed' else 'refused' end
  from information_schema.columns where table_name = 'nation' and column_name in ('ageb_id', 'cvegeo', 'CVEGEO')
""")
def guards(spark, sf):
    """What each check says of tables that satisfy it and of some that don't."""
    docs, labels, events = labelled(spark, sf), table(spark, sf, "labels"), table(spark, sf, "events")
    bare = docs.where("quality is null")
    some_value = lambda df: q.require_some_value(["quality", "toxic"], column_facts(df, ["quality", "toxic"]))
    checks = [
        ("rows", "all events", lambda: q.require_rows(events)),
        ("rows", "events of no type", lambda: q.require_rows(events.where("event_type = 'absent'"))),
        ("columns", "documents", lambda: q.require_columns(table(spark, sf, "documents"), ["text", "lang"])),
        ("columns", "labels", lambda: q.require_columns(labels, ["quality", "lang"])),
        ("values", "labels", lambda: some_value(docs)),
        ("values", "documents without label", lambda: some_value(bare)),
        ("classes", "labels", lambda: q.require_classes(docs, "quality")),
        ("classes", "good documents", lambda: q.require_classes(docs.where("quality = 1"), "quality")),
        ("classes", "documents without label", lambda: q.require_classes(bare, "quality")),
        ("features", "lineitem", lambda: q.resolve_features(table(spark, sf, "lineitem"), "l_quantity")),
        ("features", "labels", lambda: q.resolve_features(labels, "quality")),
        ("area key", "nation", lambda: q.area_key(table(spark, sf, "nation"))),
    ]
    return spark.createDataFrame([(guard, given, outcome(check)) for guard, given, check in checks], "guard string, given string, outcome string")


@catalog.add("select l_orderkey as ageb_id, l_linenumber, round(l_orderkey + l_partkey + l_suppkey + l_linenumber + l_extendedprice + l_discount + l_tax, 4) as total from lineitem")
def resolved_features(spark, sf):
    """An accepted area key, and the sum of the number columns that count as features."""
    lines = q.area_key(table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "cvegeo"))
    columns = q.resolve_features(lines, "l_quantity", never=["ageb_id"])
    total = F.col("ageb_id") + sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return lines.select("ageb_id", "l_linenumber", r6(total, 4).alias("total"))


@catalog.add("select event_id, event_type, value from events where value > 100")
def source_fallback(spark, sf):
    """An absent table and an empty filter are passed over."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    events.createOrReplaceTempView("vereda_events")
    return readers.first_nonempty(
        [
            lambda: readers.load_input(spark, "table:no_such_schema.no_such_table"),
            lambda: readers.load_input(spark, "sql:select * from vereda_events where value < -1e12"),
            lambda: readers.load_input(spark, "sql:select * from vereda_events where value > 100"),
        ]
    )


@catalog.add("""
select cast(event_id as varchar) as id, props as name, event_type as category, value as x, cast(user_id as double) as y
from events where event_type in ('absent')
""")
def typed_empty(spark, sf):
    """Points of a category that no event has: no rows, but all columns."""
    return readers.select_pois(nested_events(spark, sf), ("absent",))


@catalog.add("select doc_id, text, lang, n_chars, cast(quality as bigint) as quality from documents left join labels using (doc_id)")
def csv_roundtrip(spark, sf):
    """Texts with line breaks and quotes through a CSV folder, types inferred."""
    path = scratch_path(spark, "csv")
    writers.write_csv(labelled(spark, sf).select("doc_id", "text", "lang", "n_chars", "quality"), path)
    return readers.read_csv(spark, path)


@catalog.add("select doc_id, lang, quality from documents left join labels using (doc_id)")
def json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    rows = labelled(spark, sf).select("doc_id", "lang", "quality")
    writers.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


def _metrics(spark, sf):
    """One nested JSON record per language: sizes and label shares."""
    docs = labelled(spark, sf)
    sums = docs.groupBy("lang").agg(
        F.count("*").alias("n"), F.count("quality").alias("labelled"), F.sum("quality").alias("good"),
        F.sum("n_chars").alias("chars"),
    )
    nested = F.struct(
        "n",
        F.struct("labelled", "good", F.lit("quality").alias("name")).alias("labels"),
        F.struct(F.struct(F.try_divide("chars", "n").alias("mean")).alias("length")).alias("text"),
    )
    return sums.select("lang", F.to_json(nested).alias("payload"))


METRICS_SQL = """
with s as (select lang, count(*) as n, count(quality) as labelled, sum(quality) as good, sum(n_chars) as chars
  from documents left join labels using (doc_id) group by lang),
flat as (select lang, 'n' as path, cast(n as double) as value from s
 union all select lang, 'labels.labelled', labelled from s
 union all select lang, 'labels.good', good from s
 union all select lang, 'text.length.mean', chars / n from s)
"""


@catalog.add(METRICS_SQL + "select lang, path, round(value, 6) as value from flat where value is not null")
def run_metrics_flat(spark, sf):
    payload = runlog.parse_payload(materialize(_metrics(spark, sf), "payload"), "payload", ["lang"])
    return runlog.flatten_metrics(payload, ["lang"]).select("lang", "path", r6("value").alias("value"))


@catalog.add(
    METRICS_SQL
    + """select lang as run_name, round(max(case when path = 'n' then value end), 6) as n,
    round(max(case when path = 'text.length.mean' then value end), 6) as "text.length.mean" from flat group by lang"""
)
def run_compare(spark, sf):
    """Metrics appended to a run table, one run per language, and compared."""
    payload = runlog.parse_payload(materialize(_metrics(spark, sf), "payload"), "payload", ["lang"])
    flat = runlog.flatten_metrics(payload, ["lang"])
    path = scratch_path(spark, "runs")
    entries = flat.select(
        F.col("lang").alias("run_id"), F.lit(None).cast("string").alias("parent_id"), F.col("lang").alias("run_name"),
        F.lit("metric").alias("kind"), F.col("path").alias("key"), F.col("value").alias("num_value"),
        F.lit(None).cast("string").alias("str_value"), F.current_timestamp().alias("logged_at"),
    )
    runlog.log(entries, path)
    wide = runlog.compare_runs(runlog.read_runs(spark, path), ["n", "text.length.mean"])
    return wide.select("run_name", r6("n").alias("n"), r6("`text.length.mean`").alias("text.length.mean"))


@catalog.add("select doc_id, lang from documents order by md5(doc_id || '|42'), doc_id limit 1000")
def bounded_sample(spark, sf):
    return sm.bounded_sample(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 1000)


@catalog.add("select doc_id, lang from documents order by n_chars desc, doc_id limit 5")
def example_rows(spark, sf):
    d = table(spark, sf, "documents").withColumn("down", -F.col("n_chars"))
    return sm.first_rows(d, ["down", "doc_id"], 5).select("doc_id", "lang")


@catalog.add("""
with r as (select doc_id, row_number() over (order by md5(doc_id || '|42'), doc_id) as rn, count(*) over () as n from documents)
select doc_id, rn <= ceil(0.2 * n) as is_test from r
""")
def random_split(spark, sf):
    return sm.split_random(table(spark, sf, "documents").select("doc_id"), "doc_id")


SPLIT_SQL = """
with r as (select doc_id, quality, n_chars, lang, row_number() over (partition by quality order by md5(doc_id || '|42'), doc_id) as rn,
  count(*) over (partition by quality) as n from documents join labels using (doc_id))
"""


def judged(spark, sf):
    """Labelled documents with a predicted label and a score from the length."""
    return (
        table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
        .join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
        .withColumn("pred", (F.col("n_chars") >= 1500).cast("int"))
        .withColumn("score", F.col("n_chars") / 20000.0)
    )


@catalog.add(SPLIT_SQL + "select doc_id, quality, rn <= ceil(0.2 * n) as is_test from r")
def stratified_split(spark, sf):
    out = sm.split_stratified(judged(spark, sf), "doc_id", "quality")
    return out.select("doc_id", "quality", "is_test")


@catalog.add(SPLIT_SQL + "select doc_id, quality, cast((rn - 1) % 5 as integer) as fold from r")
def kfold_assignment(spark, sf):
    return sm.assign_folds(judged(spark, sf), "doc_id", "quality").select("doc_id", "quality", "fold")


@catalog.add("""
with r as (select doc_id, quality, row_number() over (partition by quality order by doc_id) - 1 as rk,
  count(*) over (partition by quality) as n from documents join labels using (doc_id))
select doc_id, quality, cast(case when rk < (n % 5) * (n // 5 + 1) then rk // (n // 5 + 1)
  else n % 5 + (rk - (n % 5) * (n // 5 + 1)) // (n // 5) end as integer) as fold from r
""")
def kfold_in_order(spark, sf):
    return sm.assign_folds(judged(spark, sf), "doc_id", "quality", seed=None).select("doc_id", "quality", "fold")


@catalog.add(
    "select doc_id, ('0x' || substr(md5(doc_id || '|42'), 1, 8))::bigint / 4294967296.0 < 0.2 as is_test from documents"
)
def hash_split(spark, sf):
    return sm.split_by_hash(table(spark, sf, "documents").select("doc_id"), "doc_id")


JUDGED_SQL = """
with j as (select doc_id, lang, n_chars, quality as y, cast(n_chars >= 1500 as integer) as p, n_chars / 20000.0 as s from documents join labels using (doc_id))
"""
BINARY_SQL = """
count(*) filter (y = 0 and p = 0) as tn, count(*) filter (y = 0 and p = 1) as fp,
count(*) filter (y = 1 and p = 0) as fn, count(*) filter (y = 1 and p = 1) as tp
"""
RATIOS_SQL = """
round(coalesce((tp + tn) / nullif(tn + fp + fn + tp, 0), 0), 6) as accuracy,
round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision,
round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1_score
"""


def rounded(df, *cols):
    return df.withColumns({c: r6(c) for c in cols})


FOUR = ["accuracy", "precision", "recall", "f1_score"]


@catalog.add(JUDGED_SQL + "select y, p as y_pred, count(*) as n from j group by all")
def confusion_matrix(spark, sf):
    return ev.confusion_counts(judged(spark, sf), "quality", "pred")


@catalog.add(JUDGED_SQL + f", c as (select {BINARY_SQL} from j) select tn, fp, fn, tp, {RATIOS_SQL} from c")
def binary_metrics(spark, sf):
    return rounded(ev.binary_metrics(judged(spark, sf), "quality", "pred"), *FOUR)


@catalog.add(JUDGED_SQL + f", c as (select lang, {BINARY_SQL} from j group by lang) select lang, tn, fp, fn, tp, {RATIOS_SQL} from c")
def metrics_by_group(spark, sf):
    return rounded(ev.binary_metrics(judged(spark, sf), "quality", "pred", ["lang"]), *FOUR)


CLASS_SQL = JUDGED_SQL + """, classes as (select y as label from j union select p from j),
rows as (select label, (select count(*) from j where y = label) as support, (select count(*) from j where p = label) as predicted,
  (select count(*) from j where y = label and p = label) as hits from classes),
m as (select label, support, hits, coalesce(hits / nullif(predicted, 0), 0) as precision, coalesce(hits / nullif(support, 0), 0) as recall,
  coalesce(2 * hits / nullif(support + predicted, 0), 0) as f1_score from rows)
"""


@catalog.add(CLASS_SQL + """select round(sum(hits) / sum(support), 6) as accuracy, round(avg(precision), 6) as precision_macro,
round(avg(recall), 6) as recall_macro, round(avg(f1_score), 6) as f1_macro from m""")
def macro_metrics(spark, sf):
    out = ev.macro_metrics(judged(spark, sf), "quality", "pred")
    return rounded(out, *out.columns)


@catalog.add(CLASS_SQL + """
select cast(label as varchar) as label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1_score, 6) as f1_score, support from m
union all select 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), cast(sum(support) as bigint) from m
union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6), cast(sum(support) as bigint) from m
union all select 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1_score * support) / sum(support), 6), cast(sum(support) as bigint) from m
""")
def class_report(spark, sf):
    return rounded(ev.class_report(judged(spark, sf), "quality", "pred"), "precision", "recall", "f1_score")


@catalog.add(JUDGED_SQL + """, g as (select s, count(*) filter (y = 1) as pos, count(*) filter (y <> 1) as neg from j group by s),
c as (select *, coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0) as below from g)
select cast(sum(pos) as bigint) as positives, cast(sum(neg) as bigint) as negatives,
  round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) as roc_auc from c""")
def roc_auc(spark, sf):
    return rounded(ev.roc_auc(judged(spark, sf), "quality", "score"), "roc_auc")


@catalog.add(JUDGED_SQL + """, g as (select s, count(*) filter (y = 1) as pos, count(*) filter (y <> 1) as neg from j group by s)
select round(s, 6) as threshold, round(sum(neg) over w / sum(neg) over (), 6) as fpr, round(sum(pos) over w / sum(pos) over (), 6) as tpr
from g window w as (order by s desc)""")
def roc_points(spark, sf):
    return rounded(ev.roc_points(judged(spark, sf), "quality", "score"), "threshold", "fpr", "tpr")


@catalog.add(
    JUDGED_SQL
    + f""", f as (select *, (row_number() over (partition by y order by md5(doc_id || '|42'), doc_id) - 1) % 5 as fold from j),
    c as (select fold, {BINARY_SQL} from f group by fold),
    m as (select coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1 from c)
    select round(avg(f1), 6) as cv_f1_mean, round(stddev_pop(f1), 6) as cv_f1_std from m"""
)
def fold_f1(spark, sf):
    folds = sm.assign_folds(judged(spark, sf), "doc_id", "quality")
    out = ev.fold_summary(ev.binary_metrics(folds, "quality", "pred", ["fold"]))
    return rounded(out, "cv_f1_mean", "cv_f1_std")


@catalog.add(
    JUDGED_SQL
    + f""", t as (select *, row_number() over (partition by y order by md5(doc_id || '|42'), doc_id) <= ceil(0.2 * count(*) over (partition by y)) as is_test from j),
    c as (select is_test, {BINARY_SQL} from t group by is_test),
    m as (select is_test, coalesce((tp + tn) / nullif(tn + fp + fn + tp, 0), 0) as accuracy, coalesce(tp / nullif(tp + fp, 0), 0) as precision,
      coalesce(tp / nullif(tp + fn, 0), 0) as recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1_score from c),
    u as (unpivot m on accuracy, precision, recall, f1_score into name metric value value)
    select metric, round(max(value) filter (not is_test), 6) as train, round(max(value) filter (is_test), 6) as test,
      round(max(value) filter (not is_test) - max(value) filter (is_test), 6) as gap from u group by metric"""
)
def train_test_gap(spark, sf):
    split = sm.split_stratified(judged(spark, sf), "doc_id", "quality")
    return rounded(ev.split_gap(split, "quality", "pred", "is_test"), "train", "test", "gap")
