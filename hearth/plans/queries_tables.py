"""Queries over written tables: constraints, pruning, nested documents, order, appends, gates, hot lookups, grain."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..operators import constraints as C
from ..operators import gate, lookup, order, quality
from ..session import scratch_path
from ..sources import files, schemas, sinks, warehouse
from .registry import REGISTRY, register

# ------------------------------------------------- constraints on load

# A hand-kept ledger: repeated ids, unknown households and types, amounts and states out of range.
_DIRTY_SQL = """
, dirty AS (
  SELECT event_id AS row_no, CASE WHEN event_id % 50 = 7 THEN 'TRX' || CAST(event_id - 1 AS VARCHAR)
              WHEN event_id % 89 = 5 THEN NULL WHEN event_id % 97 = 11 THEN 'TRX' || CAST(event_id AS VARCHAR) || repeat('0', 20)
              ELSE 'TRX' || CAST(event_id AS VARCHAR) END AS transaction_id,
         CASE WHEN event_id % 41 = 3 THEN 'Customer#999999999' ELSE r.household_id END AS household_id,
         CASE WHEN event_id % 53 = 9 THEN 'wood_pile' ELSE r.product_type END AS product_type, r.date,
         CASE WHEN event_id % 31 = 4 THEN r.amount_ksh * 1000 ELSE r.amount_ksh END AS amount_ksh,
         CASE WHEN event_id % 43 = 8 THEN 'unknown' WHEN event_id % 59 = 2 THEN NULL ELSE r.status END AS status
  FROM events JOIN transactions_raw r ON r.transaction_id = 'TRX' || CAST(event_id AS VARCHAR))
"""


def dirty_ledger(s):
    """``transactions_raw`` with the faults that the constraints are there to catch."""
    r = s.transactions_raw
    k = F.expr("substring(transaction_id, 4)").cast("bigint")
    own = F.col("transaction_id")
    return r.select(
        k.alias("row_no"),
        F.when(k % 50 == 7, F.concat(F.lit("TRX"), (k - 1).cast("string"))).when(k % 89 == 5, F.lit(None))
         .when(k % 97 == 11, F.concat(own, F.repeat(F.lit("0"), 20))).otherwise(own).alias("transaction_id"),
        F.when(k % 41 == 3, "Customer#999999999").otherwise(F.col("household_id")).alias("household_id"),
        F.when(k % 53 == 9, "wood_pile").otherwise(F.col("product_type")).alias("product_type"), "date",
        F.when(k % 31 == 4, F.col("amount_ksh") * 1000).otherwise(F.col("amount_ksh")).cast("decimal(16,2)").alias("amount_ksh"),
        F.when(k % 43 == 8, "unknown").when(k % 59 == 2, F.lit(None)).otherwise(F.col("status")).alias("status"))


def ledger_constraints(s):
    """The transaction table's constraints; fixed values: lengths, amounts and states of the schema and the dictionary."""
    return [C.NotNull("transaction_id"), C.MaxLength("transaction_id", 20),
            C.Check("date", F.col("date").isNull() | parse_date("date").isNotNull()),
            C.Check("amount", F.col("amount_ksh").between(-10000, 10000)),
            C.Check("status", F.col("status").isin("completed", "pending", "failed")),
            C.ForeignKey("household_id", s.dim_household, "household_id"),
            C.ForeignKey("product_type", s.dim_product, "product_type"),
            C.Unique(("transaction_id",))]


@register("constraint_rejects", _DIRTY_SQL + """
, broken AS (
  SELECT *, concat_ws(',',
      CASE WHEN transaction_id IS NULL THEN 'not_null:transaction_id' END,
      CASE WHEN length(transaction_id) > 20 THEN 'length:transaction_id' END,
      CASE WHEN date IS NOT NULL AND TRY_CAST(date AS DATE) IS NULL THEN 'check:date' END,
      CASE WHEN NOT amount_ksh BETWEEN -10000 AND 10000 THEN 'check:amount' END,
      CASE WHEN status NOT IN ('completed', 'pending', 'failed') THEN 'check:status' END,
      CASE WHEN household_id NOT IN (SELECT household_id FROM dim_household) THEN 'foreign_key:household_id' END,
      CASE WHEN product_type NOT IN (SELECT product_type FROM dim_product WHERE product_type IS NOT NULL) THEN 'foreign_key:product_type' END) AS why
  FROM dirty),
placed AS (SELECT *, row_number() OVER (PARTITION BY transaction_id, why = '' ORDER BY row_no) AS place FROM broken)
SELECT row_no, transaction_id, amount_ksh, CASE WHEN why = '' AND place > 1 THEN 'unique:transaction_id' ELSE why END AS reasons,
       why = '' AND place = 1 AS accepted
FROM placed
""", measures=("amount_ksh",), ops="S4 B5 Q1 Q6 Q7")
def q_constraint_rejects(t):
    judged = C.judge(dirty_ledger(t.star), ledger_constraints(t.star), ["row_no"])
    return judged.select("row_no", "transaction_id", "amount_ksh", F.array_join(C.REASONS, ",").alias("reasons"),
                         (F.size(C.REASONS) == 0).alias("accepted"))


# ------------------------------------------------- the written star, pruned (S3)

@register("fiscal_quarter_adoptions", """
SELECT county, (month(adoption_date) + 5) % 12 // 3 + 1 AS fiscal_quarter,
       CAST(year(adoption_date) - CASE WHEN month(adoption_date) < 7 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
       COUNT(*) AS adoptions, SUM(subsidy_amount) AS subsidy
FROM fact_adoptions_multi JOIN dim_geography USING (geography_key)
WHERE year(adoption_date) - CASE WHEN month(adoption_date) < 7 THEN 1 ELSE 0 END = 1997
  AND (month(adoption_date) + 5) % 12 // 3 + 1 IN (2, 3)
GROUP BY ALL
""", measures=("subsidy",), ops="S3 J1 D4 D5")
def q_fiscal_quarter_adoptions(t):
    """Two fiscal quarters of the written star: the calendar prunes the fact's month folders while it runs (writes while it is built)."""
    root = scratch_path(t.spark, "star")
    warehouse.write_star(t.star, root, ("dim_geography", "dim_date"), ("fact_adoptions_multi",))
    return fiscal_quarters(warehouse.WarehouseStar(t.spark, root), 1997, (2, 3))


def fiscal_quarters(star, year, quarters):
    """Adoptions of some fiscal quarters by county, from the written star."""
    months = (star.dim_date.where((F.col("fiscal_year") == year) & F.col("fiscal_quarter").isin(*quarters))
              .select((F.col("year") * 100 + F.col("month")).alias("month_key"), "fiscal_year", "fiscal_quarter").distinct())
    return (star.fact_adoptions_multi.join(F.broadcast(months), "month_key")     # at most twelve months a year
            .join(star.dim_geography.select("geography_key", "county"), "geography_key")
            .groupBy("county", F.col("fiscal_quarter").cast("bigint").alias("fiscal_quarter"), "fiscal_year")
            .agg(F.count(F.lit(1)).alias("adoptions"), F.sum("subsidy_amount").alias("subsidy")))


# ------------------------------------------------- nested documents

_DONORS_SQL = """
, counties AS (SELECT list(n_name ORDER BY n_nationkey) AS c FROM nation),
donors AS (
  SELECT s_suppkey AS k, printf('DN%06d', s_suppkey) AS donor_id, s_name AS donor_name,
         CASE WHEN s_suppkey % 2 = 0 THEN 'Foundation' ELSE 'Bilateral' END AS donor_type,
         ['Health', 'Environment', 'Gender', 'Economic'][s_suppkey % 4 + 1] AS focus_area,
         ['lives_saved', 'DALYs_avoided', 'CO2_avoided_tons', 'women_time_saved_hours', 'household_savings_ksh', 'jobs_created']
           [s_suppkey % 4 + 1 : s_suppkey % 4 + s_suppkey % 3 + 1] AS priority_metrics,
         s_suppkey * 1000 + 500000 AS funding, CASE WHEN s_suppkey % 4 = 0 THEN 'Annual' ELSE 'Quarterly' END AS reporting_frequency,
         5 + s_suppkey % 10 AS cost,
         CASE WHEN s_suppkey % 13 = 0 THEN NULL WHEN s_suppkey % 11 = 0 THEN []
              WHEN s_suppkey % 7 = 0 THEN ['All']
              ELSE list_transform(range(0, s_suppkey % 3 + 1), lambda i: c[(s_nationkey + i * 5) % len(c) + 1]) END AS preferred_counties
  FROM supplier, counties)
"""


def _donor_files(t):
    """The donors as JSON arrays of objects with array fields."""
    path = scratch_path(t.spark, "donors")
    files.write_json_arrays(files.donor_rows(t.supplier, t.nation), path, 4)
    return path


@register("load_donors", _DONORS_SQL + """
SELECT md5(donor_id) AS donor_key, donor_id, donor_name, donor_type, focus_area, CAST(funding AS DOUBLE) AS funding_available_usd,
       reporting_frequency, CAST(cost AS DOUBLE) AS cost_per_impact_target
FROM donors
""", measures=("funding_available_usd", "cost_per_impact_target"), ops="B6 S2")
def q_load_donors(t):
    """Donor documents written as JSON arrays, read and loaded (writes while it is built)."""
    return files.load_donors(t.spark, _donor_files(t)).drop("created_at")


@register("donor_reach", _DONORS_SQL + """
, wanted AS (
  SELECT donor_id, focus_area, unnest(CASE WHEN list_contains(preferred_counties, 'All')
                                           THEN (SELECT list(county) FROM dim_geography) ELSE list_distinct(preferred_counties) END) AS county,
         list_contains(preferred_counties, 'All') AS takes_all,
         len(list_intersect(priority_metrics, ['lives_saved', 'DALYs_avoided'])) > 0 AS values_health,
         len(list_filter(priority_metrics, lambda m: length(m) > 12)) AS long_metrics
  FROM donors)
SELECT donor_id, focus_area, takes_all, values_health, CAST(long_metrics AS INTEGER) AS long_metrics, COUNT(*) AS counties,
       CAST(SUM(households) AS BIGINT) AS households
FROM wanted JOIN (SELECT county, COUNT(*) AS households FROM dim_household GROUP BY county) USING (county)
GROUP BY ALL
""", ops="X1 S2 B6")
def q_donor_reach(t):
    """Households in the counties that each donor prefers, from the nested documents (writes while it is built)."""
    s = t.star
    wanted = files.donor_preferences(files.read_donors(t.spark, _donor_files(t)), s.dim_geography)
    homes = s.dim_household.groupBy("county").agg(F.count(F.lit(1)).alias("households"))
    return (wanted.join(homes, "county").groupBy("donor_id", "focus_area", "takes_all", "values_health", "long_metrics")
            .agg(F.count(F.lit(1)).alias("counties"), F.sum("households").alias("households")))


# ------------------------------------------------- global order (L4)

@register("orders_in_order", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders
""", ops="L4")
def q_orders_in_order(t):
    """Every order with its place in the order of value (writes while it is built)."""
    path = scratch_path(t.spark, "orders-in-order")
    order.write_ordered(t.orders.select("o_orderkey", "o_totalprice"), path, [F.col("o_totalprice").desc(), F.col("o_orderkey")])
    return order.ranked(t.spark.read.parquet(path))


# ------------------------------------------------- repeatable append

@register("append_batches", """
SELECT terrain_type, 'north' AS batch, COUNT(*) AS rows FROM routes_raw WHERE distance_km < 25 GROUP BY terrain_type
UNION ALL SELECT terrain_type, 'south', COUNT(*) FROM routes_raw WHERE distance_km >= 25 GROUP BY terrain_type
""", ops="S6")
def q_append_batches(t):
    """Two batches, one of them sent twice: each stands once (writes while it is built)."""
    path = scratch_path(t.spark, "batches")
    near, far = (t.star.routes_raw.where(c) for c in ("distance_km < 25", "distance_km >= 25"))
    for batch, rows in (("north", near), ("north", near), ("south", far), ("north", near)):
        sinks.append_batch(rows, path, batch)
    return sinks.read_batches(t.spark, path).groupBy("terrain_type", "batch").agg(F.count(F.lit(1)).alias("rows"))


# ------------------------------------------------- gated publication (Q13, Q10)

@register("gated_publish", """
, good AS (SELECT * FROM dim_household WHERE household_size BETWEEN 1 AND 20 AND head_age BETWEEN 18 AND 100 AND monthly_income_ksh >= 0),
m AS (
  SELECT 'clean' AS batch, (SELECT COUNT(*) FROM good) AS rows, 0 AS nulls, 0 AS failures
  UNION ALL SELECT 'raw', COUNT(*), 0, COUNT(*) - (SELECT COUNT(*) FROM good) FROM dim_household
  UNION ALL SELECT 'short', COUNT(*), 0, 0 FROM good WHERE control_group
  UNION ALL SELECT 'holes', COUNT(*), COUNT(*) FILTER (WHERE household_key % 5 = 0), 0 FROM good)
SELECT batch, rows, CAST(nulls AS BIGINT) AS nulls, CAST(failures AS BIGINT) AS failures,
       concat_ws(',', CASE WHEN rows < 0.9 * (SELECT COUNT(*) FROM good) THEN 'records' END,
                 CASE WHEN failures > 0.05 * rows THEN 'failures' END, CASE WHEN nulls > 0.02 * 3 * rows THEN 'nulls' END) AS breaches,
       (SELECT COUNT(*) FROM good) AS rows_published
FROM m
""", ops="Q13 Q10")
def q_gated_publish(t):
    """Four runs of the household table; those that break a threshold leave the published one as it is (writes while it is built)."""
    from ..functions.columns import household_is_valid
    root, h = scratch_path(t.spark, "gated-households"), t.star.dim_household
    good = h.where(household_is_valid())
    rules = gate.Rules(("county", "head_age", "monthly_income_ksh"), {"in range": household_is_valid()})
    expected = good.count()
    holes = good.withColumn("county", F.when(F.col("household_key") % 5 != 0, F.col("county")))
    runs = {"clean": good, "raw": h, "short": good.where("control_group"), "holes": holes}
    for i, (batch, rows) in enumerate(runs.items()):
        gate.publish(rows, root, batch, rules, expected, at=dt.datetime(2024, 1, 1 + i))
    published = gate.current(t.spark, root).agg(F.count(F.lit(1))).scalar()
    return gate.audit(t.spark, root).select("batch", "rows", "nulls", "failures", F.array_join("breaches", ",").alias("breaches"),
                                            published.alias("rows_published"))


# ------------------------------------------------- hot natural keys

_ONE_BUYER_SQL = """
, ledger AS (
  SELECT transaction_id, CASE WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 3 = 0 THEN (SELECT min(household_id) FROM dim_household)
                              ELSE household_id END AS household_id, amount_ksh FROM transactions_raw)
"""


@register("hot_household_lookup", _ONE_BUYER_SQL + """
SELECT transaction_id, household_key, county, amount_ksh
FROM ledger LEFT JOIN (SELECT household_id, household_key, county FROM dim_household) USING (household_id)
""", measures=("amount_ksh",), ops="J2 J3")
def q_hot_household_lookup(t):
    """A ledger in which a third of the rows is one household's, looked up by its natural key (counts keys while it is built)."""
    s = t.star
    one = s.dim_household.agg(F.min("household_id")).scalar()
    k = F.expr("substring(transaction_id, 4)").cast("bigint")
    ledger = s.transactions_raw.select("transaction_id", "amount_ksh",
                                       F.when(k % 3 == 0, one).otherwise(F.col("household_id")).alias("household_id"))
    homes = s.dim_household.select("household_id", "household_key", "county")
    return lookup.lookup(ledger, homes, "household_id").select("transaction_id", "household_key", "county", "amount_ksh")


# ------------------------------------------------- composite grain (Q6)

@register("repeated_grain", """
, grain AS (SELECT household_key, product_key, CAST(year(adoption_date) * 100 + month(adoption_date) AS INTEGER) AS month_key, NULL AS transaction_id
            FROM fact_adoptions_multi),
sent AS (SELECT 'TRX' || CAST(event_id - (CASE WHEN event_id % 50 = 7 THEN 1 ELSE 0 END) AS VARCHAR) AS transaction_id FROM events)
SELECT 'household_product_month' AS grain, household_key, product_key, month_key, CAST(NULL AS VARCHAR) AS transaction_id, COUNT(*) AS rows
FROM grain GROUP BY ALL HAVING COUNT(*) > 1
UNION ALL SELECT 'household_month', household_key, NULL, month_key, NULL, COUNT(*) FROM grain GROUP BY ALL HAVING COUNT(*) > 1
UNION ALL SELECT 'transaction', NULL, NULL, NULL, transaction_id, COUNT(*) FROM sent GROUP BY ALL HAVING COUNT(*) > 1
""", ops="Q6")
def q_repeated_grain(t):
    s = t.star
    month = (F.year("adoption_date") * 100 + F.month("adoption_date")).cast("int")
    adoptions = s.fact_adoptions_multi.select("household_key", "product_key", month.alias("month_key"))
    k = F.col("event_id")
    sent = t.events.select(F.concat(F.lit("TRX"), (k - F.when(k % 50 == 7, 1).otherwise(0)).cast("string")).alias("transaction_id"))
    out = None
    kinds = {"household_key": "bigint", "product_key": "bigint", "month_key": "int", "transaction_id": "string"}
    for name, df, keys in (("household_product_month", adoptions, ["household_key", "product_key", "month_key"]),
                           ("household_month", adoptions, ["household_key", "month_key"]), ("transaction", sent, ["transaction_id"])):
        found = quality.repeated_grain(df, keys)
        one = found.select(F.lit(name).alias("grain"),
                           *[(F.col(c) if c in keys else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()], "rows")
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------- documented rules of the loads (Q1)

# The documented lists and range, stated once more for the oracle.
_LOAD_BREAKS = (
    ("load_adoptions", "cooking_hours_range", "baseline_cooking_hours_per_day", "baseline_cooking_hours_per_day NOT BETWEEN 1 AND 8"),
    ("load_adoptions", "cooking_method_values", "baseline_cooking_method",
     "baseline_cooking_method NOT IN ('Three-stone fire', 'Charcoal stove', 'Kerosene', 'LPG', 'Electric')"),
    ("load_adoptions", "fuel_type_values", "baseline_fuel_type", "baseline_fuel_type NOT IN ('Firewood', 'Charcoal', 'LPG')"),
    ("adoption_ledger", "type_values", "type", "type NOT IN ('purchase', 'payment', 'subsidy', 'maintenance', 'refund')"),
    ("adoption_ledger", "channel_values", "payment_method", "payment_method NOT IN ('Cash', 'M-Pesa', 'Bank')"),
    ("adoption_ledger", "ledger_status_values", "status", "status NOT IN ('completed', 'pending', 'failed')"))


def _load_breaks_sql() -> str:
    parts = [f"SELECT '{source}' AS dataset, '{rule}' AS rule, '{column}' AS column_name, COUNT(*) FILTER (WHERE {bad}) AS violations, "
             f"COUNT({column}) AS checked FROM ({REGISTRY[source].sql})" for source, rule, column, bad in _LOAD_BREAKS]
    return "\nUNION ALL\n".join(parts)


@register("range_violations_loads", _load_breaks_sql(), ops="Q1", raw_sql=True)
def q_range_violations_loads(t):
    return (quality.range_violations(REGISTRY["load_adoptions"].build(t), quality.LOAD_RULES, "load_adoptions")
            .unionByName(quality.range_violations(REGISTRY["adoption_ledger"].build(t), quality.LEDGER_RULES, "adoption_ledger")))


# ------------------------------------------------- the whole catalogue

# Which columns of each table the extracts fill, and from what the oracle counts them.
_FILLED = {
    "dim_household": ("dim_household", ("household_key", "household_id", "county", "urban_rural", "gps_latitude", "gps_longitude",
                                        "head_gender", "head_age", "marital_status", "household_size", "children_under_18",
                                        "elderly_over_60", "monthly_income_ksh", "control_group", "vulnerability_factors")),
    "dim_product": ("dim_product", ("product_key", "product_id", "product_type", "product_model", "thermal_efficiency_pct",
                                    "pm25_emissions_mg_m3", "lifespan_years", "tier_rating", "unit_cost_usd", "carbon_reduction_tons_year")),
    "dim_date": ("dim_date", ("date_key", "full_date", "year", "quarter", "month", "month_name", "week", "day_of_month", "day_of_week",
                              "day_name", "is_weekend", "fiscal_year", "fiscal_quarter")),
    "dim_geography": ("dim_geography", ("geography_key", "county", "region", "population", "area_sq_km", "poverty_rate",
                                        "electrification_rate")),
    "dim_donor": ("load_donors", ("donor_key", "donor_id", "donor_name", "donor_type", "focus_area", "funding_available_usd",
                                  "reporting_frequency", "cost_per_impact_target")),
    "fact_adoptions": ("load_adoptions", ("household_key", "product_key", "adoption_date_key", "geography_key", "payment_method",
                                          "subsidy_amount", "actual_price_paid", "usage_intensity", "baseline_cooking_method",
                                          "baseline_fuel_type", "baseline_weekly_fuel_cost_ksh", "baseline_cooking_hours_per_day")),
    "fact_transactions": ("load_transactions", ("transaction_id", "household_key", "product_key", "transaction_date_key", "amount_ksh",
                                                "transaction_type", "payment_method", "status")),
    "fact_ebike_logistics": ("load_routes", ("route_id", "geography_key", "distribution_center", "route_name", "distance_km",
                                             "households_covered", "terrain_type", "ebike_required", "deliveries_per_month")),
    "fact_carbon_credits": ("load_prices", ("date_key", "price_per_ton_usd", "market_type", "standard", "verification_status",
                                            "volume_traded_tons", "kenya_premium_pct")),
    "fact_impact_metrics": ("impact_monthly", ("household_key", "product_key", "geography_key", "month_key", "dalys_avoided",
                                               "mortality_reduction", "co2_avoided_tons", "trees_saved_equivalent", "fuel_cost_savings_ksh",
                                               "time_saved_hours", "healthcare_savings_ksh", "stove_stacking_ratio")),
}


def _catalogue_sql() -> str:
    from .oracle import star
    parts = []
    for table, (source, filled) in _FILLED.items():
        body = REGISTRY[source].sql if source in REGISTRY else star(f"SELECT * FROM {source}")
        counts = ", ".join(f"COUNT({c}) AS {c}" for c in filled)
        parts.append(f"SELECT '{table}' AS table_name, column_name, filled, rows FROM (SELECT *, (SELECT COUNT(*) FROM ({body})) AS rows FROM "
                     f"(SELECT {counts} FROM ({body})) UNPIVOT (filled FOR column_name IN (COLUMNS(*))))")
    return "\nUNION ALL\n".join(parts)


@register("catalogue_load", _catalogue_sql(), ops="S4 B1 B2 B4 B5 B6 B7 B8", raw_sql=True)
def q_catalogue_load(t):
    """Every table of the catalogue loaded and typed as declared: how many values each column that has a source holds (writes while it is built)."""
    s = t.star
    out = None
    for table, (source, filled) in _FILLED.items():
        df = REGISTRY[source].build(t) if source in REGISTRY else getattr(s, source)
        loaded = schemas.conform(df, schemas.TABLES[table] if table != "dim_donor" else schemas.TABLES[table].replace("donor_key bigint", "donor_key string"))
        one = loaded.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in loaded.columns])
        pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in loaded.columns]
        one = (one.select("rows", F.inline(F.array(*pairs))).where((F.col("filled") > 0) | F.col("column_name").isin(*filled))
               .select(F.lit(table).alias("table_name"), "column_name", "filled", "rows"))
        out = one if out is None else out.unionByName(one)
    return out
