"""Multi-criteria scoring, scaling and imputation on the sales tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import Catalog, cents, r6, table
from vereda.operators import attribution as at, quality as q, scaling as scl, scoring as sc
from vereda.operators.stats import medians
from vereda.session import materialize

catalog = Catalog()

PART_COLS = ["quantity", "revenue", "discount", "tax", "size", "price"]

PART_SQL = """
select p_partkey, quantity, revenue, discount, tax,
       cast(p_size as double) as size, p_retailprice as price
from part join (
  select l_partkey,
         sum(l_quantity) as quantity,
         cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as revenue,
         cast(sum(cast(l_discount as decimal(18,2))) as double) / count(*) as discount,
         cast(sum(cast(l_tax as decimal(18,2))) as double) / count(*) as tax
  from lineitem group by l_partkey) on p_partkey = l_partkey
"""


def part_indicators(spark, sf):
    """Six indicators per part. Lines are summed per part before the join."""
    lines = (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.sum("l_quantity").alias("quantity"),
            cents("l_extendedprice").alias("revenue"),
            (cents("l_discount") / F.count("*")).alias("discount"),
            (cents("l_tax") / F.count("*")).alias("tax"),
        )
    )
    part = table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price")
    )
    joined = part.join(lines, F.col("p_partkey") == F.col("l_partkey")).select("p_partkey", *PART_COLS)
    # every later pass reads this table, not the lines
    return materialize(joined, "parts")


CUSTOMER_COLS = ["balance", "spend", "n_orders", "nation"]

CUSTOMER_SQL = """
select c_custkey, c_acctbal as balance, spend, n_orders, cast(c_nationkey as double) as nation
from customer left join (
  select o_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as spend,
         cast(count(*) as double) as n_orders
  from orders group by o_custkey) on c_custkey = o_custkey
"""


def customer_indicators(spark, sf):
    """Spend and order count per customer, missing for those who never bought."""
    spend = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(cents("o_totalprice").alias("spend"), F.count("*").cast("double").alias("n_orders"))
    )
    customer = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_nationkey").cast("double").alias("nation")
    )
    return materialize(
        customer.join(spend, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", *CUSTOMER_COLS),
        "customers",
    )


def critic_sql(source: str, cols: list[str], impute: bool = True, normalize: bool = False, on_zero: str = "uniform") -> str:
    """CTEs base, x, stats, critic(indicator, std, conflict, score, weight)."""
    fill = [f"coalesce({c}, (select median({c}) from base)) as {c}" if impute else c for c in cols]
    norm = [f"coalesce(({c} - min({c}) over ()) / nullif(max({c}) over () - min({c}) over (), 0), 0) as {c}" for c in cols]
    k = len(cols)
    stats = [f"stddev_pop({c}) as sd_{i}" for i, c in enumerate(cols)]
    for i in range(k):
        for j in range(i + 1, k):
            a, b = cols[i], cols[j]
            both = f"{a} is not null and {b} is not null"
            stats.append(
                f"coalesce(covar_pop({a}, {b}) / nullif(stddev_pop({a}) filter ({both})"
                f" * stddev_pop({b}) filter ({both}), 0), 0) as r_{i}_{j}"
            )
    rows = []
    for i, c in enumerate(cols):
        conflict = " + ".join(f"(1 - r_{min(i, j)}_{max(i, j)})" for j in range(k) if j != i)
        rows.append(
            f"select '{c}' as indicator, coalesce(sd_{i}, 0) as std, {conflict} as conflict,"
            f" greatest(coalesce(sd_{i}, 0) * ({conflict}), 0) as score from stats"
        )
    zero = f"1.0 / {k}" if on_zero == "uniform" else "null"
    raw = "x0" if normalize else "x"
    ctes = [f"base as ({source})", f"{raw} as (select {', '.join(fill)} from base)"]
    if normalize:
        ctes.append(f"x as (select {', '.join(norm)} from x0)")
    ctes += [
        f"stats as (select {', '.join(stats)} from x)",
        f"scores as ({' union all '.join(rows)})",
        "critic as (select *, case when sum(score) over () > 0 then score / sum(score) over ()"
        f" else {zero} end as weight from scores)",
    ]
    return "with " + ", ".join(ctes) + " "


WEIGHT_SELECT = (
    "select indicator, round(std, 4) as std, round(conflict, 6) as conflict, round(weight, 6) as weight from critic"
)


def shown(weights):
    return weights.select("indicator", r6("std", 4).alias("std"), r6("conflict").alias("conflict"), r6("weight").alias("weight"))


@catalog.add(critic_sql(PART_SQL, PART_COLS, normalize=True) + WEIGHT_SELECT)
def critic_weights(spark, sf):
    return shown(sc.critic_weights(part_indicators(spark, sf), PART_COLS, normalize=True))


@catalog.add(critic_sql(CUSTOMER_SQL, CUSTOMER_COLS, impute=False, on_zero="null") + WEIGHT_SELECT)
def critic_weights_raw(spark, sf):
    return shown(
        sc.critic_weights(customer_indicators(spark, sf), CUSTOMER_COLS, impute=False, on_zero="null")
    )


@catalog.add(critic_sql(CUSTOMER_SQL, CUSTOMER_COLS) + WEIGHT_SELECT)
def critic_weights_imputed(spark, sf):
    return shown(sc.critic_weights(customer_indicators(spark, sf), CUSTOMER_COLS))


@catalog.add(
    "with base as (" + PART_SQL + ") "
    + " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(coalesce(covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0), 0), 6) as r from base"
        for i, a in enumerate(PART_COLS) for b in PART_COLS[i + 1:]
    )
)
def correlation_matrix(spark, sf):
    x = part_indicators(spark, sf)
    row = sc.correlation_row(x, PART_COLS)
    pairs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r6(f"r_{i}_{i + 1 + j}").alias("r"))
        for i, a in enumerate(PART_COLS) for j, b in enumerate(PART_COLS[i + 1:])
    ]
    return row.select(F.inline(F.array(*pairs)))


def score_sql(cols: list[str] = PART_COLS, key: str = "p_partkey") -> str:
    """Adds parts(key, <term per indicator>) and scored(key, score)."""
    terms = [
        f"(select weight from critic where indicator = '{c}') * coalesce(({c} - (select min({c}) from base))"
        f" / nullif((select max({c}) - min({c}) from base), 0), 0) as {c}"
        for c in cols
    ]
    return (
        critic_sql(PART_SQL, cols, normalize=True)
        + f", parts as (select {key}, {', '.join(terms)} from base)"
        + f", scored as (select {key}, {' + '.join(cols)} as nprv_score from parts) "
    )


def part_weights(spark, sf):
    parts = part_indicators(spark, sf)
    return parts, sc.critic_weights(parts, PART_COLS, normalize=True)


@catalog.add(score_sql() + "select p_partkey, round(nprv_score, 6) as nprv_score from scored")
def weighted_score(spark, sf):
    parts, weights = part_weights(spark, sf)
    return sc.weighted_score(parts, weights, PART_COLS).select("p_partkey", r6("nprv_score").alias("nprv_score"))


@catalog.add(
    score_sql()
    + "select p_partkey, cast(nprv_score >= (select median(nprv_score) from scored) as integer) as target from scored"
)
def balanced_label(spark, sf):
    parts, weights = part_weights(spark, sf)
    scored = materialize(sc.weighted_score(parts, weights, PART_COLS).select("p_partkey", "nprv_score"), "scored")
    return sc.balanced_label(scored).select("p_partkey", "target")


@catalog.add(
    score_sql()
    + """, facts as (select median(nprv_score) as t, count(*) as n from scored)
    select indicator, round(weight, 6) as weight, round(t, 6) as threshold, n as labelled_rows,
           round((select avg(cast(nprv_score >= t as integer)) from scored), 6) as positive_rate
    from critic, facts"""
)
def critic_summary(spark, sf):
    _, summary = sc.critic_summary(part_indicators(spark, sf), PART_COLS, normalize=True)
    return summary.select(
        "indicator", r6("weight").alias("weight"), r6("threshold").alias("threshold"),
        "labelled_rows", r6("positive_rate").alias("positive_rate"),
    )


@catalog.add(
    score_sql()
    + "select p_partkey, round(nprv_score, 6) as nprv_score from scored order by scored.nprv_score desc, p_partkey limit 12"
)
def top_parts(spark, sf):
    parts, weights = part_weights(spark, sf)
    scored = sc.weighted_score(parts, weights, PART_COLS)
    return scored.orderBy(F.desc("nprv_score"), "p_partkey").limit(12).select("p_partkey", r6("nprv_score").alias("nprv_score"))


@catalog.add(
    score_sql()
    + " union all ".join(
        f"select p_partkey, '{c}' as feature, round({c} - (select avg({c}) from parts), 6) + 0.0 as contribution from parts"
        for c in PART_COLS
    )
)
def linear_attribution(spark, sf):
    parts, weights = part_weights(spark, sf)
    terms = sc.weighted_parts(parts, weights, PART_COLS)
    out = at.linear_attribution(terms, "p_partkey", PART_COLS)
    return out.select("p_partkey", "feature", r6("contribution").alias("contribution"))


@catalog.add("""
with c as (select c_nationkey as k, count(*) as customers, cast(sum(cast(c_acctbal as decimal(18,2))) as double) as customer_balance from customer group by 1),
 s as (select s_nationkey as k, count(*) as suppliers, cast(sum(cast(s_acctbal as decimal(18,2))) as double) as supplier_balance from supplier group by 1),
 o as (select c_nationkey as k, count(*) as n_orders, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as spend from orders join customer on o_custkey = c_custkey group by 1),
 l as (select s_nationkey as k, count(*) as n_lines, sum(l_quantity) as quantity from lineitem join supplier on l_suppkey = s_suppkey group by 1)
select n_nationkey as ageb_id,
  coalesce(cast(n_lines as double), 0.0) as node_connectivity,
  coalesce(cast(customers as double), cast(suppliers as double), 0.0) as place_population,
  coalesce(cast(suppliers as double), cast(customers as double), 0.0) as place_employment,
  round(coalesce(supplier_balance, 0.0), 2) as real_estate_proxy,
  coalesce(cast(n_orders as double), 0.0) as vitality_retail,
  round(coalesce(spend, 0.0), 2) as vitality_food,
  round(coalesce(customer_balance, 0.0) + coalesce(quantity, 0.0), 2) as vitality_social
from nation left join c on c.k = n_nationkey left join s on s.k = n_nationkey
 left join o on o.k = n_nationkey left join l on l.k = n_nationkey
""")
def area_indicators(spark, sf):
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    # rows are counted per customer and per supplier before they meet the areas
    per_customer = orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("t")
    )
    per_supplier = lines.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("t"))
    components = {
        "customers": customer.groupBy(F.col("c_nationkey").alias("ageb_id")).agg(
            F.count("*").alias("customers"), cents("c_acctbal").alias("customer_balance")
        ),
        "suppliers": supplier.groupBy(F.col("s_nationkey").alias("ageb_id")).agg(
            F.count("*").alias("suppliers"), cents("s_acctbal").alias("supplier_balance")
        ),
        "orders": per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("ageb_id"))
        .agg(F.sum("n").alias("n_orders"), F.sum("t").cast("double").alias("spend")),
        "lines": per_supplier.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").alias("ageb_id"))
        .agg(F.sum("n").alias("n_lines"), F.sum("t").alias("quantity")),
    }
    mapping = {
        "node_connectivity": [["n_lines"]],
        "place_population": [["customers", "suppliers"]],
        "place_employment": [["suppliers", "customers"]],
        "real_estate_proxy": [["supplier_balance"]],
        "vitality_retail": [["n_orders"]],
        "vitality_food": [["spend"]],
        "vitality_social": [["customer_balance"], ["quantity"]],
    }
    base = table(spark, sf, "nation").select(F.col("n_nationkey").alias("ageb_id"))
    out = sc.area_indicators(base, components, mapping)
    money = ["real_estate_proxy", "vitality_food", "vitality_social"]
    return out.withColumns({c: r6(c, 2) for c in money})


@catalog.add(
    f"with base as ({CUSTOMER_SQL}) select c_custkey, round(coalesce(spend, (select median(spend) from base)), 4) as spend,"
    " coalesce(n_orders, (select median(n_orders) from base)) as n_orders from base"
)
def median_impute(spark, sf):
    out = q.impute_median(customer_indicators(spark, sf), ["spend", "n_orders"])
    return out.select("c_custkey", r6("spend", 4).alias("spend"), "n_orders")


@catalog.add(
    f"with base as ({CUSTOMER_SQL}) select c_custkey, coalesce(spend, 0.0) as spend, coalesce(n_orders, 0.0) as n_orders from base"
)
def zero_impute(spark, sf):
    return q.impute_zero(customer_indicators(spark, sf), ["spend", "n_orders"]).select("c_custkey", "spend", "n_orders")


@catalog.add("""
select event_id, try_cast(json_extract_string(props, '$.k') as double) as k,
       try_cast(event_type as double) as event_type, try_cast(props as double) as props
from events
""")
def coerce_numeric(spark, sf):
    raw = table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), "event_type", "props"
    )
    return q.coerce_numeric(raw, ["k", "event_type", "props"])


@catalog.add(
    "select " + ", ".join(f"round(median({c}), 6) as {c}" for c in ["l_quantity", "l_extendedprice", "l_discount"]) + " from lineitem"
)
def column_medians(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    return medians(table(spark, sf, "lineitem"), cols).select(*[r6(c).alias(c) for c in cols])


@catalog.add("""
select p_partkey,
  round(coalesce((p_size - min(p_size) over ()) / nullif(cast(max(p_size) over () - min(p_size) over () as double), 0), 0), 6) as p_size_scaled,
  round(coalesce((p_retailprice - min(p_retailprice) over ()) / nullif(max(p_retailprice) over () - min(p_retailprice) over (), 0), 0), 6) as p_retailprice_scaled
from part
""")
def minmax_scale(spark, sf):
    cols = ["p_size", "p_retailprice"]
    out = scl.minmax_scale(table(spark, sf, "part"), cols)
    return out.select("p_partkey", *[r6(f"{c}_scaled").alias(f"{c}_scaled") for c in cols])


@catalog.add("""
select c_custkey,
  round(coalesce((c_acctbal - avg(c_acctbal) over ()) / nullif(stddev_pop(c_acctbal) over (), 0), 0), 6) + 0.0 as c_acctbal_scaled,
  round(coalesce((c_nationkey - avg(c_nationkey) over ()) / nullif(stddev_pop(c_nationkey) over (), 0), 0), 6) + 0.0 as c_nationkey_scaled
from customer
""")
def zscore_scale(spark, sf):
    cols = ["c_acctbal", "c_nationkey"]
    out = scl.zscore_scale(table(spark, sf, "customer"), cols)
    return out.select("c_custkey", *[r6(f"{c}_scaled").alias(f"{c}_scaled") for c in cols])


@catalog.add("select o_orderkey, case o_orderstatus when 'O' then 1 when 'F' then 0 end as o_orderstatus from orders")
def value_map(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return q.map_label(orders, "o_orderstatus", {"O": 1, "F": 0})
