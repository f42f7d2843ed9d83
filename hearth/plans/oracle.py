"""DuckDB SQL that states each query independently of the Spark code.

``STAR`` mirrors ``hearth.sources.adapters`` as common table expressions over
the driver's parquet views; each oracle is ``STAR + body``. Unused CTEs are
never evaluated.
"""

STAR = """
WITH dim_geography AS (
  SELECT CAST(n_nationkey AS BIGINT) AS geography_key, n_name AS county, r_name AS region,
         CAST(1000000 + 50000 * n_nationkey AS INTEGER) AS population,
         CAST(1000 + 250 * n_nationkey AS DECIMAL(10,2)) AS area_sq_km,
         CAST(15 + 2.5 * n_nationkey AS DECIMAL(5,2)) AS poverty_rate,
         CAST(90 - 3 * n_nationkey AS DECIMAL(5,2)) AS electrification_rate
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
hh0 AS (
  SELECT c_custkey AS household_key, c_name AS household_id, n_name AS county,
         CASE WHEN c_custkey % 5 < 2 THEN 'Urban' ELSE 'Rural' END AS urban_rural,
         CAST(CAST(c_custkey % 111 AS DECIMAL(10,6)) * 0.1 - 5.5 AS DECIMAL(10,6)) AS gps_latitude,
         CAST(33.0 + CAST(c_custkey % 97 AS DECIMAL(10,6)) * 0.1 AS DECIMAL(10,6)) AS gps_longitude,
         CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS head_gender,
         CAST(10 + c_custkey % 97 AS INTEGER) AS head_age,
         CASE WHEN c_custkey % 7 = 5 THEN 'Widowed' WHEN c_custkey % 7 = 6 THEN 'Divorced'
              WHEN c_custkey % 7 >= 3 THEN 'Single' ELSE 'Married' END AS marital_status,
         CAST(c_custkey % 23 AS INTEGER) AS household_size,
         CAST(c_custkey % 6 AS INTEGER) AS children_under_18,
         CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 5 AS DECIMAL(12,2)) AS monthly_income_ksh,
         (c_custkey % 20 = 0) AS has_disability,
         (c_mktsegment = 'HOUSEHOLD') AS control_group
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
dim_household AS (
  SELECT *, CASE WHEN head_age > 60 THEN 1 ELSE 0 END AS elderly_over_60,
         NULLIF(concat_ws(',',
            CASE WHEN head_age > 60 THEN 'Elderly' END,
            CASE WHEN marital_status IN ('Widowed', 'Divorced') AND children_under_18 > 0 THEN 'Single Parent' END,
            CASE WHEN monthly_income_ksh < 10000 THEN 'Low Income' END,
            CASE WHEN has_disability THEN 'Disability' END), '') AS vulnerability_factors
  FROM hh0
),
dim_product AS (
  SELECT p_partkey AS product_key, printf('PRD%05d', p_partkey) AS product_id,
         CASE p_type WHEN 'ECONOMY' THEN 'charcoal_stove' WHEN 'STANDARD' THEN 'charcoal_stove'
                     WHEN 'LARGE' THEN 'firewood_stove' WHEN 'MEDIUM' THEN 'firewood_stove'
                     WHEN 'PROMO' THEN 'pellet_stove' WHEN 'SMALL' THEN 'solar_lantern' END AS product_type,
         p_name AS product_model,
         CAST(20 + p_size * 0.5 AS DECIMAL(5,2)) AS thermal_efficiency_pct,
         CAST(p_size * 10 AS DECIMAL(8,2)) AS pm25_emissions_mg_m3,
         CAST(2 + p_size % 4 AS INTEGER) AS lifespan_years,
         CAST(1 + p_size % 5 AS INTEGER) AS tier_rating,
         CAST(10 + p_size * 0.5 AS DECIMAL(10,2)) AS unit_cost_usd,
         CAST(p_size * 0.05 AS DECIMAL(5,2)) AS carbon_reduction_tons_year
  FROM part
),
first_orders AS (
  SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM (
    SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
    FROM orders) WHERE rn = 1
),
adopt_src AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, c.c_nationkey
  FROM first_orders o JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE c.c_mktsegment <> 'HOUSEHOLD'
),
multi_src AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, c.c_nationkey
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE c.c_mktsegment <> 'HOUSEHOLD'
),
fact_adoptions AS (
  SELECT o_orderkey AS adoption_key, o_custkey AS household_key,
         CAST(o_orderkey % (SELECT greatest(COUNT(*), 1) FROM part) AS BIGINT) AS product_key,
         CAST(c_nationkey AS BIGINT) AS geography_key,
         CAST(o_orderdate AS DATE) AS adoption_date,
         CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS adoption_date_key,
         CASE o_orderkey % 4 WHEN 0 THEN 'Cash' WHEN 1 THEN 'Mobile Money' WHEN 2 THEN 'Credit'
              ELSE 'Full Subsidy' END AS payment_method,
         CAST(o_orderkey % 4 AS DECIMAL(10,2)) AS subsidy_amount,
         CAST(500 AS DECIMAL(10,2)) AS actual_price_paid,
         CAST(CAST(o_orderkey % 101 AS DECIMAL(5,2)) * 0.01 AS DECIMAL(3,2)) AS usage_intensity,
         CAST(o_orderkey % 1500 AS DECIMAL(10,2)) AS baseline_weekly_fuel_cost_ksh
  FROM adopt_src
),
fact_adoptions_multi AS (
  SELECT o_orderkey AS adoption_key, o_custkey AS household_key,
         CAST(o_orderkey % (SELECT greatest(COUNT(*), 1) FROM part) AS BIGINT) AS product_key,
         CAST(c_nationkey AS BIGINT) AS geography_key,
         CAST(o_orderdate AS DATE) AS adoption_date,
         CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS adoption_date_key,
         CASE o_orderkey % 4 WHEN 0 THEN 'Cash' WHEN 1 THEN 'Mobile Money' WHEN 2 THEN 'Credit'
              ELSE 'Full Subsidy' END AS payment_method,
         CAST(o_orderkey % 4 AS DECIMAL(10,2)) AS subsidy_amount,
         CAST(500 AS DECIMAL(10,2)) AS actual_price_paid,
         CAST(CAST(o_orderkey % 101 AS DECIMAL(5,2)) * 0.01 AS DECIMAL(3,2)) AS usage_intensity,
         CAST(o_orderkey % 1500 AS DECIMAL(10,2)) AS baseline_weekly_fuel_cost_ksh
  FROM multi_src
),
fact_transactions AS (
  SELECT event_id AS transaction_key, 'TRX' || CAST(event_id AS VARCHAR) AS transaction_id,
         user_id AS household_key, CAST(ts AS DATE) AS transaction_date,
         CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS INTEGER) AS transaction_date_key,
         CAST(value AS DECIMAL(12,2)) AS amount_ksh, event_type AS transaction_type,
         CASE WHEN event_id % 20 = 0 THEN 'failed' WHEN event_id % 20 = 1 THEN 'pending'
              ELSE 'completed' END AS status,
         ts AS created_ts, ts + (event_id % 48) * INTERVAL 1 HOUR AS modified_ts
  FROM events
),
households_raw AS (
  SELECT h.household_id, h.county, h.urban_rural, h.gps_latitude, h.gps_longitude, h.head_gender,
         h.head_age, h.marital_status, h.household_size, h.children_under_18, h.monthly_income_ksh,
         h.has_disability, h.control_group, h.elderly_over_60, h.vulnerability_factors,
         CASE WHEN NOT h.control_group AND a.adoption_date IS NOT NULL
              THEN (CASE WHEN a.o_orderstatus = 'P' THEN NULL ELSE p.product_type END)
              ELSE 'none' END AS product_type,
         CASE WHEN NOT h.control_group AND a.adoption_date IS NOT NULL THEN a.adoption_date END AS adoption_date,
         CASE WHEN NOT h.control_group AND a.adoption_date IS NOT NULL THEN
           CASE a.o_orderkey % 4 WHEN 0 THEN 'Cash' WHEN 1 THEN 'Mobile Money' WHEN 2 THEN 'Credit'
                ELSE 'Full Subsidy' END END AS payment_method,
         CASE WHEN NOT h.control_group AND a.adoption_date IS NOT NULL THEN
           CAST(CAST(a.o_orderkey % 101 AS DECIMAL(5,2)) * 0.01 AS DECIMAL(3,2)) END AS usage_intensity,
         CASE WHEN NOT h.control_group AND a.adoption_date IS NOT NULL THEN
           CAST(a.o_orderkey % 4 AS DECIMAL(10,2)) END AS subsidy_amount,
         CASE WHEN NOT h.control_group AND a.adoption_date IS NOT NULL THEN
           ['Three-stone fire', 'Charcoal stove', 'Kerosene', 'LPG', 'Electric'][a.o_orderkey % 5 + 1]
           END AS baseline_cooking_method,
         CASE WHEN NOT h.control_group AND a.adoption_date IS NOT NULL THEN
           ['Charcoal', 'Firewood', 'Kerosene', 'LPG', 'Mixed'][a.o_orderkey % 5 + 1] END AS baseline_fuel_type,
         CASE WHEN NOT h.control_group AND a.adoption_date IS NOT NULL THEN
           CAST(1 + (a.o_orderkey % 9) * 0.5 AS DECIMAL(5,2)) END AS cooking_hours_per_day,
         CASE WHEN NOT h.control_group AND a.adoption_date IS NOT NULL THEN
           CAST(a.o_orderkey % 1500 AS DECIMAL(10,2)) END AS weekly_fuel_cost_ksh
  FROM dim_household h
  LEFT JOIN (SELECT printf('Customer#%09d', o_custkey) AS household_id, o_orderkey, o_orderstatus,
                    o_orderkey % (SELECT greatest(COUNT(*), 1) FROM part) AS catalogue_key,
                    CAST(o_orderdate AS DATE) AS adoption_date FROM first_orders) a
         ON a.household_id = h.household_id
  LEFT JOIN dim_product p ON p.product_key = a.catalogue_key
),
transactions_raw AS (
  SELECT 'TRX' || CAST(event_id AS VARCHAR) AS transaction_id,
         CASE WHEN event_type <> 'signup' THEN printf('Customer#%09d', user_id) END AS household_id,
         CASE WHEN event_id % 97 = 0 THEN 'not-a-date' ELSE strftime(CAST(ts AS DATE), '%Y-%m-%d') END AS date,
         CAST(value AS DECIMAL(12,2)) AS amount_ksh, event_type AS type,
         CASE event_id % 3 WHEN 0 THEN 'cash' WHEN 1 THEN 'mobile_money' ELSE 'donor_fund' END AS payment_method,
         CASE WHEN event_id % 20 = 0 THEN 'failed' WHEN event_id % 20 = 1 THEN 'pending'
              ELSE 'completed' END AS status,
         CASE event_id % 4 WHEN 0 THEN 'charcoal_stove' WHEN 1 THEN 'firewood_stove'
              WHEN 2 THEN 'pellet_stove' ELSE 'solar_lantern' END AS product_type
  FROM events
),
routes_raw AS (
  SELECT printf('RT%04d', s_suppkey) AS route_id,
         CASE WHEN s_acctbal < 0 THEN 'UNMAPPED' ELSE n_name END AS county,
         'DC-' || n_name AS distribution_center, 'Route ' || CAST(s_suppkey AS VARCHAR) AS route_name,
         CAST(5 + s_suppkey % 50 AS DECIMAL(10,2)) AS distance_km,
         CAST(100 + s_suppkey % 400 AS INTEGER) AS households_covered,
         CASE s_suppkey % 3 WHEN 0 THEN 'flat' WHEN 1 THEN 'hilly' ELSE 'mixed' END AS terrain_type,
         (s_suppkey % 4 <> 0) AS ebike_required,
         CAST(20 + s_suppkey % 30 AS INTEGER) AS deliveries_per_month
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
prices_raw AS (
  SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date,
         CAST(5 + (o_orderkey % 2000) * 0.01 AS DECIMAL(10,2)) AS price_per_ton_usd,
         'voluntary' AS market_type, 'CCP' AS standard,
         CASE WHEN o_orderkey % 3 < 2 THEN 'verified' ELSE 'projected' END AS verification_status,
         CAST(10000 + o_orderkey % 90000 AS INTEGER) AS volume_traded_tons,
         CAST(5 + (o_orderkey % 101) * 0.1 AS DECIMAL(5,2)) AS kenya_premium_pct
  FROM orders
),
monthly_prices AS (
  SELECT strftime(date_trunc('month', CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS date,
         SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS total_price, COUNT(*) AS orders
  FROM orders GROUP BY 1
)
"""


def star(body: str) -> str:
    return STAR + body
