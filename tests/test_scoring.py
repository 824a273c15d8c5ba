import pytest
from pyspark.sql import functions as F

from vereda.operators import quality as q, scaling, scoring as sc
from vereda.operators.stats import medians, rank_within, running_totals

ROWS = [("a", 1.0, 10.0, 5.0), ("b", 2.0, 8.0, 5.0), ("c", 4.0, 6.0, 5.0), ("d", 8.0, None, 5.0)]


@pytest.fixture()
def areas(spark):
    return spark.createDataFrame(ROWS, "area_id string, p double, q double, k double")


def weights_of(df):
    return {r["indicator"]: r["weight"] for r in df.collect()}


def test_weights_sum_to_one_and_constant_gets_none(areas):
    w = weights_of(sc.critic_weights(areas, ["p", "q", "k"]))
    assert sum(w.values()) == pytest.approx(1.0)
    assert w["k"] == 0.0
    assert min(w.values()) >= 0


def test_weights_by_hand(spark):
    # sd 1 and 2, correlation -1: conflict is 2 on both sides
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 0.0)], "p double, q double")
    w = weights_of(sc.critic_weights(df, ["p", "q"]))
    assert w == {"p": pytest.approx(1 / 3), "q": pytest.approx(2 / 3)}


def test_all_constant_is_uniform_or_null(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 3, "p double, q double")
    assert weights_of(sc.critic_weights(df, ["p", "q"])) == {"p": 0.5, "q": 0.5}
    assert weights_of(sc.critic_weights(df, ["p", "q"], on_zero="null")) == {"p": None, "q": None}


def test_all_null_indicator_is_rejected(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "p double, q double")
    with pytest.raises(ValueError, match="usable value"):
        sc.critic_weights(df, ["p", "q"])
    with pytest.raises(ValueError, match="absent"):
        sc.critic_weights(df, ["p", "absent"])


def test_score_uses_medians_and_range(areas, spark):
    weights = spark.createDataFrame([("p", 0.5), ("q", 0.5)], "indicator string, weight double")
    got = {r["area_id"]: r["s"] for r in sc.weighted_score(areas, weights, ["p", "q", "k"], "s").collect()}
    # q of d becomes the median 8, half way between 6 and 10; k has no weight
    assert got["d"] == pytest.approx(0.5 * 1 + 0.5 * 0.5)
    assert got["a"] == pytest.approx(0.5)
    assert all(0 <= v <= 1 for v in got.values())


def test_label_keeps_missing_scores_at_zero(spark):
    df = spark.createDataFrame([(1, 0.2), (2, 0.8), (3, None)], "id int, nprv_score double")
    got = {r["id"]: r["target"] for r in sc.balanced_label(df).collect()}
    assert got == {1: 0, 2: 1, 3: 0}
    fixed = {r["id"]: r["target"] for r in sc.balanced_label(df, threshold=0.1).collect()}
    assert fixed == {1: 1, 2: 1, 3: 0}


def test_ensure_label(spark):
    given = spark.createDataFrame([(1, 0.5, 7)], "id int, s double, y int")
    assert "target" in sc.ensure_label(given, given, "y").columns


def test_medians_by_bracket_equal_plain(spark):
    df = spark.range(5000).select(
        (F.col("id") * 7919 % 5003 / 3.0).alias("u"),
        # a third of all rows hold one value
        F.when(F.col("id") % 3 == 0, 1.5).otherwise(F.col("id") * 31 % 977 / 1.0).alias("hot"),
        F.when(F.col("id") % 2 == 0, F.col("id") * 1.0).alias("gaps"),
    )
    cols = ["u", "hot", "gaps"]
    plain = df.agg(*[F.median(c).alias(c) for c in cols]).first()
    assert medians(df, cols, rows_per_task=100).first() == plain == medians(df, cols).first()
    assert medians(df.limit(0), cols).first() == (None, None, None)


def test_running_totals_in_ranges_equal_one_window(spark):
    df = spark.range(1000).select((F.col("id") * 617 % 1009).alias("o"), (F.col("id") % 7).alias("n"))
    one = {r["o"]: r["cum_n"] for r in running_totals(df, "o", ["n"]).collect()}
    many = {r["o"]: r["cum_n"] for r in running_totals(df, "o", ["n"], rows_per_task=90).collect()}
    assert one == many and max(one.values()) == sum(i % 7 for i in range(1000))


def test_rank_within_is_dense_per_group(spark):
    df = spark.range(600).select("id", (F.col("id") % 3 == 0).alias("g"), F.md5(F.col("id").cast("string")).alias("d"))
    got = rank_within(df, "g", "d", "id", "r", hex_digits=1).collect()
    for g, n in ((True, 200), (False, 400)):
        members = sorted((r["d"], r["r"]) for r in got if r["g"] == g)
        assert [r for _, r in members] == list(range(1, n + 1))


def test_scaling_of_constant_columns_is_zero(areas):
    assert {r["k_scaled"] for r in scaling.minmax_scale(areas, ["k"]).collect()} == {0.0}
    assert {r["k_scaled"] for r in scaling.zscore_scale(areas, ["k"]).collect()} == {0.0}


def test_minmax_ignores_affine_change(areas):
    moved = areas.withColumn("p", F.col("p") * 3 + 11)
    a = [r["p_scaled"] for r in scaling.minmax_scale(areas, ["p"]).orderBy("area_id").collect()]
    b = [r["p_scaled"] for r in scaling.minmax_scale(moved, ["p"]).orderBy("area_id").collect()]
    assert a == pytest.approx(b)


def test_zscore_uses_training_rows_only(spark):
    df = spark.createDataFrame([(1.0, True), (3.0, True), (100.0, False)], "x double, train boolean")
    got = [r["x_scaled"] for r in scaling.zscore_scale(df, ["x"], fit_on=F.col("train")).orderBy("x").collect()]
    assert got == pytest.approx([-1.0, 1.0, 98.0])


def test_checks(spark, areas):
    with pytest.raises(ValueError):
        q.require_rows(areas.limit(0))
    with pytest.raises(ValueError):
        q.require_classes(areas, "k")
    assert q.resolve_features(areas.withColumn("r", F.lit(1)), "target") == ["p", "q", "k", "r"]
    with pytest.raises(ValueError):
        q.resolve_features(areas, "target")
    assert "ageb_id" in q.area_key(areas.withColumnRenamed("area_id", "CVEGEO")).columns


def test_map_label_touches_text_only(spark):
    text = spark.createDataFrame([("M",), ("B",), ("X",)], "d string")
    assert [r[0] for r in q.map_label(text, "d", {"M": 1, "B": 0}).collect()] == [1, 0, None]
    numbers = spark.createDataFrame([(1,), (0,)], "d int")
    assert [r[0] for r in q.map_label(numbers, "d", {"M": 1, "B": 0}).collect()] == [1, 0]


def test_area_indicators_take_first_present_source(spark):
    base = spark.createDataFrame([("x",), ("y",), ("z",)], "ageb_id string")
    a = spark.createDataFrame([("x", 5.0)], "ageb_id string, first double")
    b = spark.createDataFrame([("x", 7.0), ("y", 9.0)], "ageb_id string, second double")
    out = sc.area_indicators(
        base, {"a": a, "b": b}, {"pop": [["first", "second"]], "sum": [["first"], ["second"]]}
    )
    assert sorted(map(tuple, out.collect())) == [("x", 5.0, 12.0), ("y", 9.0, 9.0), ("z", 0.0, 0.0)]
