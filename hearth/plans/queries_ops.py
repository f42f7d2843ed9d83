"""Derived-column, date, load, ledger and source/sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.dates import date_key, parse_date
from ..functions.impact import logistic
from ..operators import dims, facts
from ..session import scratch_path
from ..sources import files, schemas, sinks
from .registry import register

# ------------------------------------------------------------ derived columns


@register("income_cut", """
SELECT household_key, monthly_income_ksh,
       CASE WHEN monthly_income_ksh > 0 AND monthly_income_ksh <= 10000 THEN 'Low'
            WHEN monthly_income_ksh > 10000 AND monthly_income_ksh <= 30000 THEN 'Medium'
            WHEN monthly_income_ksh > 30000 THEN 'High' END AS income_band
FROM dim_household
""", measures=("monthly_income_ksh",), ops="F5 T8")
def q_income_cut(t):
    h = t.star.dim_household
    return h.select("household_key", "monthly_income_ksh",
                    C.cut("monthly_income_ksh", [0, 10000, 30000, float("inf")],
                          ["Low", "Medium", "High"]).alias("income_band"))


@register("adopted_only", """
SELECT household_id, product_type, adoption_date FROM households_raw
WHERE product_type IS NOT NULL AND product_type <> 'none'
""", ops="F8 T2")
def q_adopted_only(t):
    return (t.star.households_raw.where(C.is_adopted())
            .select("household_id", "product_type", "adoption_date"))


@register("vulnerability_tags", """
SELECT household_key, vulnerability_factors,
       list_contains(string_split(vulnerability_factors, ','), 'Elderly') AS is_elderly,
       list_contains(string_split(vulnerability_factors, ','), 'Single Parent') AS is_single_parent
FROM dim_household
""", ops="F11 F10")
def q_vulnerability_tags(t):
    tags = F.split(F.col("vulnerability_factors"), ",")
    return t.star.dim_household.select(
        "household_key", "vulnerability_factors",
        F.array_contains(tags, "Elderly").alias("is_elderly"),
        F.array_contains(tags, "Single Parent").alias("is_single_parent"))


@register("vulnerability_score", """
SELECT household_key,
       (CASE WHEN head_gender = 'Female' THEN 1 ELSE 0 END)
     + (CASE WHEN monthly_income_ksh < 10000 THEN 2 ELSE 0 END)
     + (CASE WHEN children_under_18 > 3 THEN 1 ELSE 0 END)
     + (CASE WHEN elderly_over_60 > 0 THEN 1 ELSE 0 END)
     + (CASE WHEN COALESCE(vulnerability_factors LIKE '%Disability%', false) THEN 2 ELSE 0 END)
       AS vulnerability_score
FROM dim_household
""", ops="F12")
def q_vulnerability_score(t):
    return t.star.dim_household.select("household_key",
                                       C.vulnerability_score().alias("vulnerability_score"))


_RAW_USAGE_SQL = ("CASE WHEN adoption_key % 17 = 0 THEN NULL "
                  "ELSE CAST(adoption_key % 131 AS DECIMAL(5,2)) * 0.01 END")


@register("usage_clip", f"""
SELECT adoption_key, usage_raw,
       CASE WHEN usage_raw IS NOT NULL THEN greatest(0, least(1, usage_raw)) END AS usage_clipped
FROM (SELECT adoption_key, {_RAW_USAGE_SQL} AS usage_raw FROM fact_adoptions_multi)
""", measures=("usage_raw", "usage_clipped"), ops="F14 T13")
def q_usage_clip(t):
    k = F.col("adoption_key")
    raw = F.when(k % 17 != 0, (k % 131).cast("decimal(5,2)") * F.lit(0.01).cast("decimal(2,2)"))
    return (t.star.fact_adoptions_multi.select("adoption_key", raw.alias("usage_raw"))
            .withColumn("usage_clipped", C.clip("usage_raw", 0, 1)))


_CRM_SQL = """
, crm AS (
  SELECT CAST(household_key AS VARCHAR) AS salesforce_id, household_id, county,
         county || '-' || CAST(household_key % 8 AS VARCHAR) AS sub_county,
         'Ward ' || CAST(household_key % 40 AS VARCHAR) AS ward, 'Village ' || CAST(household_key % 400 AS VARCHAR) AS village,
         urban_rural, gps_latitude, gps_longitude, head_gender,
         CAST(trunc(COALESCE(TRY_CAST(CASE WHEN household_key % 13 = 0 THEN 'unknown'
                                           ELSE CAST(head_age AS VARCHAR) END AS DOUBLE), 0)) AS INTEGER) AS head_age,
         CAST(trunc(COALESCE(TRY_CAST(CASE WHEN household_key % 11 = 0 THEN ''
                                           ELSE CAST(household_size AS VARCHAR) END AS DOUBLE), 1)) AS INTEGER) AS household_size,
         children_under_18, monthly_income_ksh, control_group
  FROM dim_household)
"""


@register("crm_household_clean", _CRM_SQL + "SELECT * FROM crm",
          measures=("monthly_income_ksh", "gps_latitude", "gps_longitude"), ops="F2 F3 F13")
def q_crm_clean(t):
    return files.clean_crm_households(files.crm_extract(t.star.dim_household))


@register("crm_household_transform", _CRM_SQL + """
SELECT *, CASE WHEN monthly_income_ksh > 30000 THEN 'High' WHEN monthly_income_ksh > 10000 THEN 'Medium'
               WHEN monthly_income_ksh > 0 THEN 'Low' END AS income_bracket
FROM crm
WHERE head_age BETWEEN 18 AND 100 AND household_size BETWEEN 1 AND 20 AND monthly_income_ksh >= 0
""", measures=("monthly_income_ksh", "gps_latitude", "gps_longitude"), ops="F2 F3 F5 F7 F13")
def q_crm_transform(t):
    return files.transform_crm_households(files.crm_extract(t.star.dim_household))


@register("date_key_facts", """
SELECT CAST(strftime(CAST(date AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
       CAST(total_price AS DOUBLE) / orders AS avg_order_value, orders
FROM monthly_prices
""", measures=("avg_order_value",), ops="F15 D9 B8")
def q_date_key_facts(t):
    p = t.star.monthly_prices
    return p.select(date_key(parse_date("date")).alias("date_key"),
                    (F.col("total_price").cast("double") / F.col("orders")).alias("avg_order_value"),
                    "orders")


@register("adoption_curve", """
SELECT adoption_key, days_since_start,
       1.0 / (1.0 + exp(-0.02 * (CAST(days_since_start AS DOUBLE) - 180.0))) AS adoption_probability,
       greatest(8, days_since_start // 7) AS weeks_active_floor,
       CAST(make_date(year(adoption_date), 1, 1) + CAST(days_since_start AS INTEGER) AS DATE) AS curve_date
FROM (SELECT adoption_key, adoption_date,
             CAST(date_diff('day', make_date(year(adoption_date), 1, 1), adoption_date) AS INTEGER) AS days_since_start
      FROM fact_adoptions)
""", measures=("adoption_probability",), ops="F18 D8 N1")
def q_adoption_curve(t):
    f = t.star.fact_adoptions
    start = F.trunc("adoption_date", "year")
    d = F.datediff(F.col("adoption_date"), start)
    return (f.select("adoption_key", d.alias("days_since_start"), start.alias("_start"))
            .select("adoption_key", "days_since_start",
                    logistic("days_since_start").alias("adoption_probability"),
                    F.greatest(F.lit(8), F.floor(F.col("days_since_start") / 7).cast("int"))
                    .alias("weeks_active_floor"),
                    F.date_add("_start", F.col("days_since_start")).alias("curve_date")))


# ----------------------------------------------------------------- dims

DIM_DATE_SQL = """
, b AS (SELECT MIN(d0) AS s, MAX(d1) AS e FROM (
    SELECT MIN(adoption_date) AS d0, MAX(adoption_date) AS d1 FROM fact_adoptions_multi
    UNION ALL SELECT MIN(transaction_date), MAX(transaction_date) FROM fact_transactions)),
spine AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
       CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
       isodow(d) >= 6 AS is_weekend,
       CAST(year(d) - CASE WHEN month(d) < 7 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
       CAST(((month(d) + 5) % 12) // 3 + 1 AS INTEGER) AS fiscal_quarter
FROM spine
"""


@register("dim_date", DIM_DATE_SQL, ops="B2 D1 D2 D3 D4 D5")
def q_dim_date(t):
    s = t.star
    bounds = dims.date_bounds((s.fact_adoptions_multi, F.col("adoption_date")),
                              (s.fact_transactions, F.col("transaction_date")))
    return dims.dim_date_between(bounds)


# ----------------------------------------------------------------- loads

@register("load_adoptions", """
SELECT h.household_key, p.product_key, g.geography_key,
       CAST(strftime(r.adoption_date, '%Y%m%d') AS INTEGER) AS adoption_date_key,
       r.payment_method, r.subsidy_amount, r.usage_intensity,
       r.baseline_cooking_method, r.baseline_fuel_type,
       r.cooking_hours_per_day AS baseline_cooking_hours_per_day,
       r.weekly_fuel_cost_ksh AS baseline_weekly_fuel_cost_ksh,
       CAST(500 AS DECIMAL(10,2)) AS actual_price_paid
FROM households_raw r
JOIN dim_household h ON r.household_id = h.household_id
LEFT JOIN (SELECT product_type, MIN(product_key) AS product_key FROM dim_product GROUP BY product_type) p
  ON r.product_type = p.product_type
JOIN dim_geography g ON r.county = g.county
WHERE r.product_type IS NOT NULL AND r.product_type <> 'none'
""", measures=("subsidy_amount", "usage_intensity", "baseline_weekly_fuel_cost_ksh",
               "baseline_cooking_hours_per_day", "actual_price_paid"), ops="B4 J2 J3 A10 F15 F16")
def q_load_adoptions(t):
    s = t.star
    return facts.load_adoptions(s.households_raw, s.dim_household, s.dim_product, s.dim_geography)


@register("load_transactions", """
SELECT r.transaction_id, h.household_key, p.product_key,
       CAST(strftime(TRY_CAST(r.date AS DATE), '%Y%m%d') AS INTEGER) AS transaction_date_key,
       r.amount_ksh, r.type AS transaction_type, r.payment_method, r.status
FROM transactions_raw r
LEFT JOIN dim_household h ON r.household_id = h.household_id
LEFT JOIN (SELECT product_type, MIN(product_key) AS product_key FROM dim_product GROUP BY product_type) p
  ON r.product_type = p.product_type
WHERE h.household_key IS NOT NULL AND TRY_CAST(r.date AS DATE) IS NOT NULL
""", measures=("amount_ksh",), ops="B5 J3 J7 F2 D9")
def q_load_transactions(t):
    s = t.star
    return facts.load_transactions(s.transactions_raw, s.dim_household, s.dim_product)


@register("load_prices", """
SELECT CAST(strftime(TRY_CAST(date AS DATE), '%Y%m%d') AS INTEGER) AS date_key, price_per_ton_usd, market_type,
       standard, verification_status, volume_traded_tons, kenya_premium_pct
FROM prices_raw
""", measures=("price_per_ton_usd", "kenya_premium_pct"), ops="B8 F15 D9")
def q_load_prices(t):
    return facts.load_prices(t.star.prices_raw)


@register("load_routes", """
SELECT r.route_id, g.geography_key, r.distribution_center, r.route_name, r.distance_km,
       r.households_covered, r.terrain_type, r.ebike_required, r.deliveries_per_month
FROM routes_raw r LEFT JOIN dim_geography g ON r.county = g.county
WHERE g.geography_key IS NOT NULL
""", measures=("distance_km",), ops="B7 J3 J7")
def q_load_routes(t):
    s = t.star
    return facts.load_routes(s.routes_raw, s.dim_geography)


@register("route_ids", """
SELECT route_id, route_name, CAST(substr(route_id, 3) AS BIGINT) AS route_number FROM routes_raw
""", ops="C1")
def q_route_ids(t):
    return t.star.routes_raw.select("route_id", "route_name",
                                    F.expr("substring(route_id, 3)").cast("bigint").alias("route_number"))


# ------------------------------------------------------------- ledger

def _ledger_input(f):
    k = F.col("adoption_key")
    return f.select("adoption_key", "household_key", "adoption_date", "payment_method",
                    (F.lit(2) + k % 4).cast("int").alias("n_installments"),
                    F.when(k % 10 < 3, (F.lit(3) + (k / 10).cast("bigint") % 10).cast("int"))
                     .alias("maintenance_months"),
                    (F.lit(50) + k % 151).cast("int").alias("maintenance_amount"),
                    *[c for c in ("product_type",) if c in f.columns])


_LEDGER_INPUT_SQL = """
, li AS (
  SELECT adoption_key, household_key, adoption_date, payment_method,
         CAST(2 + adoption_key % 4 AS INTEGER) AS n_installments,
         CASE WHEN adoption_key % 10 < 3 THEN CAST(3 + (adoption_key // 10) % 10 AS INTEGER) END AS maintenance_months,
         CAST(50 + adoption_key % 151 AS INTEGER) AS maintenance_amount
  FROM fact_adoptions_multi),
inst AS (
  SELECT adoption_key, household_key, i AS installment_no,
         make_date(year(adoption_date + INTERVAL (i) MONTH), month(adoption_date + INTERVAL (i) MONTH),
           least(day(adoption_date),
                 min(day(last_day(adoption_date + INTERVAL (i) MONTH)))
                   OVER (PARTITION BY adoption_key ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))
           AS due_date
  FROM li, LATERAL generate_series(1, n_installments) AS s(i)
  WHERE payment_method = 'Credit')
"""


@register("installment_schedule", _LEDGER_INPUT_SQL + """
SELECT adoption_key, CAST(installment_no AS INTEGER) AS installment_no, due_date FROM inst
""", ops="D6 T9")
def q_installments(t):
    return facts.installment_schedule(_ledger_input(t.star.fact_adoptions_multi))


@register("adoption_ledger", _LEDGER_INPUT_SQL + """
, entries AS (
  SELECT adoption_key, household_key, 0 AS place, 'purchase' AS type, adoption_date AS date, 500 AS amount_ksh, payment_method,
         'completed' AS status FROM li
  UNION ALL
  SELECT adoption_key, household_key, 1, 'subsidy', adoption_date, 300, 'donor_fund', 'completed' FROM li
  WHERE payment_method <> 'Full Subsidy'
  UNION ALL
  SELECT adoption_key, household_key, 1 + installment_no, 'payment', due_date, 100, 'mobile_money',
         CASE WHEN (adoption_key + installment_no) % 20 < 17 THEN 'completed'
              WHEN (adoption_key + installment_no) % 20 < 19 THEN 'pending' ELSE 'failed' END FROM inst
  UNION ALL
  SELECT adoption_key, household_key, 99, 'maintenance', CAST(adoption_date + INTERVAL (maintenance_months) MONTH AS DATE),
         maintenance_amount, CASE WHEN adoption_key % 2 = 0 THEN 'cash' ELSE 'mobile_money' END, 'completed'
  FROM li WHERE maintenance_months IS NOT NULL)
SELECT 'TRX' || CAST(adoption_key AS VARCHAR) || '-'
         || CAST(row_number() OVER (PARTITION BY adoption_key ORDER BY place) - 1 AS VARCHAR) AS transaction_id,
       adoption_key, household_key, product_type, type, date, amount_ksh, payment_method, status
FROM entries JOIN (SELECT adoption_key, product_type FROM fact_adoptions_multi LEFT JOIN dim_product USING (product_key))
     USING (adoption_key)
""", ops="B9 D7")
def q_ledger(t):
    adoptions = t.star.fact_adoptions_multi
    types = t.star.dim_product.select("product_key", "product_type")
    return facts.adoption_ledger(_ledger_input(adoptions.join(types, "product_key", "left"))).drop("seq")


IMPACT_MONTHLY_SQL = """
, imp AS (
  SELECT f.household_key, f.product_key, f.geography_key, f.adoption_date, f.usage_intensity,
         p.pm25_emissions_mg_m3 * (0.00082 * 0.001) * f.usage_intensity AS mortality,
         p.pm25_emissions_mg_m3 * f.usage_intensity AS pm25,
         p.carbon_reduction_tons_year * f.usage_intensity AS co2,
         p.pm25_emissions_mg_m3 * (24.5 * 0.001) * f.usage_intensity AS dalys,
         f.baseline_weekly_fuel_cost_ksh * 52 * f.usage_intensity AS fuel,
         2.5 * 365 * f.usage_intensity AS hours,
         5000 * f.usage_intensity AS health
  FROM fact_adoptions_multi f
  JOIN dim_product p ON f.product_key = p.product_key
  JOIN dim_geography g ON f.geography_key = g.geography_key),
rows AS (
  SELECT imp.*, date_trunc('month', adoption_date) + INTERVAL (m) MONTH AS mth
  FROM imp, LATERAL generate_series(0, 11) AS s(m))
SELECT household_key, product_key, MIN(geography_key) AS geography_key,
       CAST(year(mth) * 100 + month(mth) AS INTEGER) AS month_key,
       CAST(SUM(mortality) AS DOUBLE) / 12 AS mortality_reduction,
       CAST(SUM(co2 * 0.17) AS DOUBLE) / 12 AS trees_saved_equivalent,
       CAST(SUM(pm25) AS DOUBLE) / 12 AS pm25_reduced,
       CAST(SUM(co2) AS DOUBLE) / 12 AS co2_avoided_tons,
       CAST(SUM(dalys) AS DOUBLE) / 12 AS dalys_avoided,
       CAST(SUM(fuel) AS DOUBLE) / 12 AS fuel_cost_savings_ksh,
       CAST(SUM(hours) AS DOUBLE) / 12 AS time_saved_hours,
       CAST(SUM(health) AS DOUBLE) / 12 AS healthcare_savings_ksh,
       COUNT(*) AS active_adoptions,
       CAST(MAX(usage_intensity) AS DOUBLE) AS stove_stacking_ratio
FROM rows GROUP BY household_key, product_key, month_key
"""


@register("impact_monthly", IMPACT_MONTHLY_SQL, measures=("co2_avoided_tons", "dalys_avoided", "fuel_cost_savings_ksh", "time_saved_hours",
               "healthcare_savings_ksh", "stove_stacking_ratio", "mortality_reduction", "trees_saved_equivalent",
               "pm25_reduced"), scale=10, ops="A17")
def q_impact_monthly(t):
    s = t.star
    return facts.impact_monthly(s.order_adoptions, s.dim_product, s.dim_geography,
                                members=s.programme_households)


# ------------------------------------------------------------ sources

@register("src_csv_roundtrip", """
SELECT household_key, household_id, county, head_age, monthly_income_ksh, vulnerability_factors
FROM dim_household
""", measures=("monthly_income_ksh",), ops="S1 S8 T1")
def q_csv_roundtrip(t):
    cols = "household_key bigint, household_id string, county string, head_age int, " \
           "monthly_income_ksh decimal(12,2), vulnerability_factors string"
    df = t.star.dim_household.select("household_key", "household_id", "county", "head_age",
                                     "monthly_income_ksh", "vulnerability_factors")
    path = scratch_path(t.spark, "csv-roundtrip")
    files.write_csv(df, path)
    return files.read_csv(t.spark, path, cols)


@register("json_props_extract", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""", ops="S2 X1")
def q_json_props(t):
    e = t.events
    return e.select("event_id", "event_type",
                    F.from_json("props", "k bigint").getField("k").alias("k"))


@register("incremental_extract", """
SELECT transaction_id, household_key, created_ts, modified_ts FROM fact_transactions
WHERE modified_ts > TIMESTAMP '2024-01-20 00:00:00' OR created_ts > TIMESTAMP '2024-01-20 00:00:00'
""", ops="S11")
def q_incremental(t):
    return sinks.incremental(t.star.fact_transactions, "2024-01-20 00:00:00", latest_change="47 hours").select(
        "transaction_id", "household_key", "created_ts", "modified_ts")


def _household_delta(events):
    """Profile updates arriving as events, by natural key: signups are new households."""
    new = F.col("event_type") == "signup"
    return events.select(
        F.when(new, F.format_string("Signup#%012d", F.col("event_id")))
         .otherwise(F.format_string("Customer#%09d", F.col("user_id"))).alias("household_id"),
        "ts", "event_id",
        F.concat(F.lit("County "), (F.col("event_id") % 47).cast("string")).alias("county"),
        (F.col("value").cast("decimal(10,2)") * F.lit(100)).cast("decimal(12,2)")
         .alias("monthly_income_ksh"),
        F.when(F.col("event_type") != "error", (F.col("event_id") % 9 + 1).cast("int"))
         .alias("household_size"))


@register("upsert_household", """
, delta AS (
  SELECT CASE WHEN event_type = 'signup' THEN printf('Signup#%012d', event_id)
              ELSE printf('Customer#%09d', user_id) END AS household_id,
         ts, event_id, 'County ' || CAST(event_id % 47 AS VARCHAR) AS county,
         CAST(CAST(value AS DECIMAL(10,2)) * 100 AS DECIMAL(12,2)) AS monthly_income_ksh,
         CASE WHEN event_type <> 'error' THEN CAST(event_id % 9 + 1 AS INTEGER) END AS household_size
  FROM events),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY ts DESC, event_id DESC) AS rn
                 FROM delta) WHERE rn = 1)
SELECT COALESCE(b.household_id, d.household_id) AS household_id,
       CASE WHEN b.household_id IS NOT NULL THEN b.county ELSE d.county END AS county,
       CASE WHEN d.household_id IS NOT NULL THEN d.monthly_income_ksh ELSE b.monthly_income_ksh END AS monthly_income_ksh,
       CASE WHEN d.household_id IS NOT NULL THEN d.household_size ELSE b.household_size END AS household_size,
       CASE WHEN d.household_id IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' END AS updated_at,
       CASE WHEN b.household_id IS NOT NULL AND d.household_id IS NOT NULL THEN 'updated'
            WHEN d.household_id IS NOT NULL THEN 'inserted' ELSE 'unchanged' END AS change
FROM (SELECT household_id, county, monthly_income_ksh, household_size FROM dim_household) b
FULL OUTER JOIN latest d ON b.household_id = d.household_id
""", measures=("monthly_income_ksh",), ops="S12 W3")
def q_upsert(t):
    base = t.star.dim_household.select("household_id", "county", "monthly_income_ksh", "household_size")
    return sinks.upsert(base, _household_delta(t.events), "household_id",
                        ["monthly_income_ksh", "household_size"], order=["ts", "event_id"],
                        updated_at=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


@register("crm_adoption_clean", """
SELECT CAST(adoption_key AS VARCHAR) AS salesforce_id, adoption_date,
       CAST(strftime(adoption_date, '%Y%m%d') AS INTEGER) AS adoption_date_key, payment_method,
       CASE WHEN adoption_key % 13 = 0 THEN 0.7::DOUBLE WHEN adoption_key % 17 = 0 THEN 1.0::DOUBLE
            WHEN adoption_key % 19 = 0 THEN 0.0::DOUBLE ELSE CAST(usage_intensity AS DOUBLE) END AS usage_intensity
FROM fact_adoptions
""", measures=("usage_intensity",), ops="F2 F13 F14 F15")
def q_crm_adoption_clean(t):
    raw = files.crm_adoption_extract(t.star.fact_adoptions)
    return files.clean_crm_adoptions(raw).select(
        "salesforce_id", "adoption_date", "adoption_date_key", "payment_method", "usage_intensity")


# ---------------------------------------------- written tables, read back

@register("bronze_load_checks", """
SELECT 'households' AS source, COUNT(*) AS rows, CAST(0 AS BIGINT) AS corrupt_rows,
       COUNT(county) AS first_column_filled, 'OK' AS status FROM dim_household
UNION ALL SELECT 'routes', COUNT(*), 0, COUNT(route_id), 'OK' FROM routes_raw
UNION ALL SELECT 'routes_none', 0, 0, 0, 'Warning'
UNION ALL SELECT 'products', COUNT(*), COUNT(*) FILTER (WHERE product_key % 10 = 3), COUNT(*), 'Warning' FROM dim_product
""", ops="S1 S8")
def q_bronze_load_checks(t):
    """CSV extracts written with columns in another order, quotes, line breaks and bad values."""
    s, out = t.star, None
    key = F.col("product_key")
    products = s.dim_product.select(
        "product_type", F.concat(F.lit('a "quoted"\nname, '), "product_model").alias("product_model"),
        F.when(key % 10 == 3, F.lit("twelve")).otherwise(F.col("lifespan_years").cast("string")).alias("lifespan_years"))
    for name, df, schema in (
            ("households", s.dim_household.select("household_key", "county", "head_age"),
             "county string, head_age int, household_key bigint"),
            ("routes", s.routes_raw.select("terrain_type", "route_id", "distance_km"),
             "route_id string, distance_km decimal(10,2), terrain_type string"),
            ("routes_none", s.routes_raw.where("distance_km < 0").select("route_id", "distance_km"),
             "distance_km decimal(10,2), route_id string"),
            ("products", products, "product_model string, lifespan_years int, product_type string")):
        path = scratch_path(t.spark, f"bronze-{name}")
        files.write_csv(df, path)
        one = files.bronze_check(name, files.read_csv(t.spark, path, schema, corrupt="_corrupt_record", multiline=name == "products"))
        out = one if out is None else out.unionByName(one)
    return out


@register("sink_append", """
SELECT terrain_type, 2 * COUNT(*) AS rows FROM routes_raw GROUP BY terrain_type
""", ops="S6")
def q_sink_append(t):
    path = scratch_path(t.spark, "sink-append")
    for _ in range(2):
        sinks.append(t.star.routes_raw, path, partition_by=["terrain_type"])
    return t.spark.read.parquet(path).groupBy("terrain_type").agg(F.count(F.lit(1)).alias("rows"))


@register("sink_replace", """
SELECT terrain_type, COUNT(*) AS rows FROM routes_raw WHERE ebike_required GROUP BY terrain_type
""", ops="S7")
def q_sink_replace(t):
    path = scratch_path(t.spark, "sink-replace")
    sinks.replace(t.star.routes_raw, path)
    sinks.replace(t.star.routes_raw.where("ebike_required"), path)
    return t.spark.read.parquet(path).groupBy("terrain_type").agg(F.count(F.lit(1)).alias("rows"))


@register("json_export", """
SELECT geography_key, county, population, CAST(poverty_rate AS DOUBLE) AS poverty_rate FROM dim_geography
""", ops="S9")
def q_json_export(t):
    path = scratch_path(t.spark, "json-export")
    sinks.export_json(t.star.dim_geography.select("geography_key", "county", "population", "poverty_rate"), path)
    return files.read_json(t.spark, path, "geography_key bigint, county string, population int, poverty_rate double",
                           multiline=False)


@register("sql_views", """
SELECT county, COUNT(*) FILTER (WHERE urban_rural = 'Urban') AS urban, COUNT(*) AS households
FROM dim_household GROUP BY county
""", ops="S10")
def q_sql_views(t):
    files.register_views(t.spark, {"hearth_households": t.star.dim_household})
    return t.spark.sql("SELECT county, count_if(urban_rural = 'Urban') AS urban, count(*) AS households "
                       "FROM hearth_households GROUP BY county")


@register("conform_products", """
SELECT md5(product_id) AS product_key, product_id, product_type, CAST(lifespan_years AS INTEGER) AS lifespan_years,
       CAST(unit_cost_usd AS DOUBLE) AS unit_cost_usd, CAST(NULL AS INTEGER) AS maintenance_frequency_months
FROM dim_product
""", measures=("unit_cost_usd",), ops="B1 B3")
def q_conform_products(t):
    raw = t.star.dim_product.drop("product_key")
    return schemas.conform(raw, schemas.DIM_PRODUCT, key="product_key", natural_key="product_id").select(
        "product_key", "product_id", "product_type", "lifespan_years", "unit_cost_usd", "maintenance_frequency_months")


@register("refresh_audit", """
SELECT 'silver_households' AS output, COUNT(*) AS rows FROM dim_household
WHERE household_size BETWEEN 1 AND 20 AND head_age BETWEEN 18 AND 100 AND monthly_income_ksh >= 0
UNION ALL SELECT 'silver_impact_calculations', COUNT(*) FROM fact_adoptions
  WHERE product_key IN (SELECT product_key FROM dim_product) AND geography_key IN (SELECT geography_key FROM dim_geography)
UNION ALL SELECT 'gold_executive_summary', 1
UNION ALL SELECT 'gold_county_performance', COUNT(DISTINCT geography_key) FROM fact_adoptions
""", ops="R1 Q13")
def q_refresh_audit(t):
    """The full run into the shared folder; its audit row, one output per row."""
    from . import refresh
    out = refresh.run(t.spark, t.sf_dir)["output"]
    audit = t.spark.read.parquet(f"{out}/run_audit").where("success")
    return (audit.select(F.explode("rows").alias("output", "rows"))
            .where(F.col("output").isin("silver_households", "silver_impact_calculations", "gold_executive_summary",
                                        "gold_county_performance")))
