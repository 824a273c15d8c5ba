"""Row equality, dotted metric names, and forests of many components."""

import datetime as dt
import random

import numpy as np
import pytest

from vereda.llm import near_duplicates, quality as rules
from vereda.operators import graph, paths, quality
from vereda.session import materialize
from vereda.sources import readers, runlog, writers


def test_duplicates_follow_distinct(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    rows = [
        (t, 0.0, [1.0, float("nan")], None), (t.replace(microsecond=2), 0.0, [1.0, float("nan")], None),
        (t, -0.0, [1.0, float("nan")], None), (None, float("nan"), None, "a"), (None, float("nan"), None, "a"), (None, None, None, "a"),
    ]
    df = spark.createDataFrame(rows, "t timestamp_ntz, x double, a array<double>, `a.s` string")
    got = quality.duplicate_count(df).first()
    assert tuple(got) == (6, df.distinct().count(), 6 - df.distinct().count()) == (6, 4, 2)


def test_metric_names_with_dots(spark):
    df = spark.sql("select named_struct('a.b', 1.5D, 'c', named_struct('d', 2)) as m").select("m.*")
    assert sorted(tuple(r) for r in runlog.flatten_metrics(df).collect()) == [("a.b", 1.5), ("c.d", 2.0)]


def test_forest_of_many_components(spark):
    edges = spark.range(3000).selectExpr("id * 2 as a", "id * 2 + 1 as b", "cast(id % 7 as double) as cost")
    assert graph.spanning_forest(edges).count() == 3000


def test_chain_rounds_shrink(spark, monkeypatch):
    steps = []

    def counted(df, label, *more):
        out = materialize(df, label, *more)
        if label == "runs":
            steps.append(out.count())
        return out

    monkeypatch.setattr(graph, "materialize", counted)
    line = [(i, i + 1, 1.0) for i in range(400)] + [(1000 + i, 1001 + i, 0.5) for i in range(99)] + [(1000, 1099, 0.5)]
    loop = [(2000, 2001, 1.0), (2001, 2002, 1.0), (2000, 2002, 1.0), (2000, 2003, 4.0), (None, None, 7.0)]
    out = graph.contract_chains(spark.createDataFrame(line + loop, "a long, b long, length double")).collect()
    assert sorted(map(tuple, out), key=str) == sorted(
        [(0, 400, 400.0, 400), (1000, 1000, 50.0, 100), (2000, 2000, 3.0, 3), (2000, 2003, 4.0, 1), (None, None, 7.0, 1)], key=str
    )
    # a round takes what is left of the one before
    assert steps[0] == 505 and sum(steps) < 5 * steps[0] and steps[-1] < 20


def test_corridor_stays_near_its_terminals(spark, monkeypatch):
    r = random.Random(5)
    pairs = sorted({(r.randrange(60), 1000 + r.randrange(600)) for _ in range(6000)})
    edges = spark.createDataFrame([(a, b, float(r.randint(1, 50))) for a, b in pairs], "u long, v long, cost double")
    ends = spark.createDataFrame([(1000 + 7 * i,) for i in range(9)], "node_id long")
    whole = sorted(map(tuple, graph.steiner_tree(edges, ends).collect()))

    def refused(*_):
        raise AssertionError("the whole graph was cut into blocks")

    monkeypatch.setattr(paths, "grow_blocks", refused)
    assert sorted(map(tuple, graph.steiner_tree(edges, ends, block_arcs=500).collect())) == whole
    arcs = graph.undirected_min(edges)
    near = graph.meeting_paths(materialize(arcs), ends.withColumnRenamed("node_id", "node"))
    rows = {x["node"]: tuple(x) for x in near.collect()}
    full = graph.shortest_paths(graph.both_ways(arcs), ends.withColumnRenamed("node_id", "node"))
    assert 9 <= len(rows) < 600 and rows.items() <= {x["node"]: tuple(x) for x in full.collect()}.items()


def test_csv_pieces_of_few_lines(spark, tmp_path, monkeypatch):
    r = random.Random(2)
    texts = ["y" + "".join(r.choice(['a', '"', ",", "\n", "\n\n", "b c"]) for _ in range(r.randint(1, 9))) + "x" for _ in range(60)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, text string")
    writers.write_csv(df.repartition(3), str(tmp_path / "csv"))
    for lines in (1, 2, 5):
        monkeypatch.setattr(readers, "PIECE_LINES", lines, raising=True)
        got = readers.read_csv(spark, str(tmp_path / "csv"), "k string, text string")
        assert sorted(map(tuple, got.collect())) == sorted((str(i), t) for i, t in enumerate(texts))


def test_pairs_of_many_bands_meet_once(spark, monkeypatch):
    r = random.Random(8)
    rows, sizes = [], []
    for i in range(12):
        words = [str(r.randrange(10**6)) for _ in range(200)]
        other = [f"x{w}" if k % 14 == 7 else w for k, w in enumerate(words)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]

    def stored(df, label="step", **more):
        out = materialize(df, label, **more)
        if label == "near-cells":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(near_duplicates, "materialize", stored)
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2)
    # 28 of 227 shingles apart: alike enough for the sketches, but no link
    assert all(x["kept"] for x in got.collect()) and sizes == [24]


def test_quality_query_tells_bytes_apart(spark, tmp_path):
    plain = "the year 1111 saw a new road to the north and the year 1111 saw it end in the sand of a dry lake for good"
    texts = [plain] * 40 + [plain.replace("1", "7")] + [plain.replace("t", "T")] * 3 + [plain.replace("t", "Q"), "naïve 日本語 \x00"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    got = {x["doc_id"]: x["log_ppl"] for x in rules.op11_quality_rules(spark, str(tmp_path)).collect()}
    assert got[0] == got[39] and got[40] > got[0] + 0.01 and abs(got[44] - got[41]) > 0.001
    model = rules.fit(table, 4, rules.BYTES)
    for context in (b"the", b"\xe6\x97\xa5", b"q~\x00"):
        codes = rules.grams([context + b"?"], 4, rules.BYTES)[0][3] & ~np.uint32(255) | np.arange(256, dtype=np.uint32)
        assert (10 ** model.log10(codes)).sum() == pytest.approx(1.0)


def test_quality_counts_in_pieces(spark, monkeypatch):
    table = spark.createDataFrame([(i, f"{i} and {i * i} words" * 30) for i in range(50)], "doc_id long, text string").coalesce(1)
    whole = sorted(map(tuple, rules.gram_counts(table, 4, rules.BYTES).collect()))
    monkeypatch.setattr(rules, "HELD", 100)
    assert sorted(map(tuple, rules.gram_counts(table, 4, rules.BYTES).collect())) == whole
