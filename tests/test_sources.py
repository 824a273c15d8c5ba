import csv

import pytest
from pyspark.sql import functions as F

from vereda.functions import text as tx
from vereda.sources import readers, runlog, writers
from vereda.streaming import rows as stream_rows

CSV = '''id,name,score,flag,gone
1,"a, ""b""",1.5,True,NA
2,"line
break",nan,False,
3,None,2,true,null
'''


def test_csv_types_and_missing_tokens(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(CSV)
    df = readers.read_csv(spark, str(path))
    assert dict(df.dtypes) == {"id": "bigint", "name": "string", "score": "double", "flag": "boolean", "gone": "string"}
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, 'a, "b"', 1.5, True, None), (2, "line\nbreak", None, False, None), (3, None, 2.0, True, None),
    ]
    fixed = readers.read_csv(spark, str(path), "id int, name int, score float, flag string, gone string")
    assert fixed.schema["score"].dataType.simpleString() == "float" and fixed.first()["name"] is None


@pytest.mark.parametrize("split", [200, 1 << 20])
def test_csv_files_are_split_at_records(spark, tmp_path, split):
    rows = [(i, f'line "{i}"\n\n,"",\nend' if i % 3 else "plain", "x" * (i % 40), "" if i % 5 else "a,b") for i in range(120)]
    for part in range(2):
        with open(tmp_path / f"{part}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(["id", "text", "filler", "more"])
            out.writerows(rows[part::2])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = readers.read_csv(spark, str(tmp_path), "id int, text string, filler string, more string")
        got = sorted(map(tuple, df.collect()))
        records = readers.csv_records(spark, str(tmp_path))
        assert records.count() == 120
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [tuple(v or None for v in r) if r[0] else (0, *(v or None for v in r[1:])) for r in rows]


def test_sinks_read_back(spark, tmp_path):
    df = spark.createDataFrame([("c", "t", "p\nq", None, "u", 2)], "company string, review_title string, pros string, cons string, source_url string, page_number int")
    writers.write_reviews(df, str(tmp_path / "r"))
    assert readers.read_csv(spark, str(tmp_path / "r"), "company string, review_title string, pros string, cons string, source_url string, page_number int").collect() == df.collect()
    writers.write_parquet(df, str(tmp_path / "p"), ["company"])
    assert readers.load_input(spark, str(tmp_path / "p") + "/").count() >= 1


def test_first_nonempty(spark):
    empty, full = spark.range(0), spark.range(2)
    absent = lambda: spark.table("absent_table")
    assert readers.first_nonempty([absent, lambda: empty, lambda: full]).count() == 2
    with pytest.raises(ValueError):
        readers.first_nonempty([absent, lambda: empty])
    with pytest.raises(ZeroDivisionError):
        readers.first_nonempty([lambda: 1 / 0])


def test_pois_prune_and_push_down(spark, tmp_path):
    path = str(tmp_path / "pois")
    spark.range(20).select(
        F.col("id").cast("string").alias("id"),
        F.struct(F.lit("n").alias("primary"), F.lit("long").alias("common")).alias("names"),
        F.struct(F.when(F.col("id") % 2 == 0, "retail").otherwise("x").alias("primary"), F.lit("z").alias("alternate")).alias("categories"),
        F.when(F.col("id") > 3, F.col("id") * 1.0).alias("x"), F.lit(1.0).alias("y"), F.lit("unused").alias("other"),
    ).write.parquet(path)
    df = readers.read_pois(spark, path, ("retail",))
    assert df.count() == 8 and df.columns == ["id", "name", "category", "x", "y"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "categories.primary" in plan.split("PushedFilters")[1] and "alternate" not in plan and "unused" not in plan


def test_metrics_from_nested_json(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": 2.5, "d": "x", "e": [1]}, "f": null, "g": true}',)], "j string")
    flat = runlog.flatten_metrics(runlog.parse_payload(df, "j"))
    assert sorted(map(tuple, flat.collect())) == [("a", 1.0), ("b.c", 2.5), ("g", 1.0)]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    for name, value in (("one", 0.5), ("two", 0.75)):
        payload = spark.range(1).select(F.lit(value).alias("f1"), F.lit("x").alias("note"))
        runlog.log(runlog.metric_entries(payload, name, "job"), path)
        runlog.log(runlog.text_entries(spark, {"model": name, "k": 3}, name, "job"), path)
    runs = runlog.read_runs(spark, path)
    assert runs.where("kind = 'param'").count() == 4
    wide = {r["run_id"]: r["f1"] for r in runlog.compare_runs(runs, ["f1"]).collect()}
    assert wide == {"one": 0.5, "two": 0.75}


def test_stateless_operators_on_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "Good PAY!", None), (2, " ", "bad 1 hours")], "id int, pros string, cons string").write.parquet(source)
    stream = spark.readStream.schema("id int, pros string, cons string").parquet(source)
    out = stream_rows.clean_stream(stream_rows.segment_stream(stream, ["id"], ["pros", "cons"]), "raw_text")
    query = out.writeStream.format("memory").queryName("cleaned").start()
    query.processAllAvailable()
    query.stop()
    got = sorted((r["id"], r["segment_label"], r["clean_text"], r["text_length"]) for r in spark.table("cleaned").collect())
    assert got == [(1, "pros", "good pay", 2), (2, "cons", "bad hours", 2)]


def test_html_entities(spark):
    df = spark.createDataFrame([("&lt;b&gt; &amp;lt; &ntilde;",)], "t string")
    assert df.select(tx.unescape_html(F.col("t"))).first()[0] == "<b> &lt; ñ"


def test_targets_and_replaced_table(spark, tmp_path, monkeypatch):
    path = tmp_path / "targets.csv"
    path.write_text('company,url\nA,"http://h/a,b.htm"\nB,http://h/b.html?x=1\n')
    targets = readers.read_targets(spark, str(path))
    assert [tuple(r) for r in targets.orderBy("company").collect()] == [("A", "http://h/a,b.htm"), ("B", "http://h/b.html?x=1")]
    spark.sql(f"create database if not exists vereda_test location '{tmp_path}/db'")
    for df in (targets, targets.limit(1)):
        writers.replace_table(df, "vereda_test.targets")
    assert readers.load_input(spark, "table:vereda_test.targets").count() == 1
    spark.sql("drop database vereda_test cascade")
