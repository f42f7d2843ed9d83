"""Queries whose results are kept up to date between runs: S11, S12, G4-G8, R1, S6, Q13."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import gold_state
from ..session import scratch_path
from ..sources import extract
from ..sources.ranges import RangeTable
from .queries import COUNTY_SQL, ENVIRONMENT_SQL, EXECUTIVE_SQL, GENDER_SQL, HEALTH_SQL, households_sql
from .queries_ops import _household_delta
from .registry import register

# ------------------------------------------------------- S12 by key range


@register("merge_changed_ranges", """
, delta AS (
  SELECT CASE WHEN event_type = 'signup' THEN printf('Signup#%012d', event_id)
              ELSE printf('Customer#%09d', user_id) END AS household_id,
         ts, event_id, 'County ' || CAST(event_id % 47 AS VARCHAR) AS county,
         CAST(CAST(value AS DECIMAL(10,2)) * 100 AS DECIMAL(12,2)) AS monthly_income_ksh,
         CASE WHEN event_type <> 'error' THEN CAST(event_id % 9 + 1 AS INTEGER) END AS household_size
  FROM events),
newest AS (
  SELECT household_id, arg_max(struct_pack(i := monthly_income_ksh, s := household_size, c := county), (ts, event_id)) AS last,
         max(ts) AS changed FROM delta GROUP BY household_id)
SELECT coalesce(b.household_id, n.household_id) AS household_id,
       CASE WHEN b.household_id IS NULL THEN n.last.c ELSE b.county END AS county,
       CASE WHEN n.household_id IS NULL THEN b.monthly_income_ksh ELSE n.last.i END AS monthly_income_ksh,
       CASE WHEN n.household_id IS NULL THEN b.household_size ELSE n.last.s END AS household_size,
       CASE WHEN changed >= TIMESTAMP '2024-01-25 00:00:00' THEN TIMESTAMP '2024-02-01 00:00:00'
            WHEN changed >= TIMESTAMP '2024-01-15 00:00:00' THEN TIMESTAMP '2024-01-25 00:00:00'
            WHEN changed IS NOT NULL THEN TIMESTAMP '2024-01-15 00:00:00' END AS updated_at
FROM (SELECT household_id, county, monthly_income_ksh, household_size FROM dim_household) b
FULL OUTER JOIN newest n ON b.household_id = n.household_id
""", measures=("monthly_income_ksh",), ops="S12 W3")
def q_merge_changed_ranges(t):
    """Three batches of profile changes merged into a table laid out by key range (writes while it is built)."""
    base = (t.star.dim_household.select("household_id", "county", "monthly_income_ksh", "household_size")
            .withColumn("updated_at", F.lit(None).cast("timestamp_ntz")))
    table = RangeTable.create(base, scratch_path(t.spark, "households-by-range"), "household_id", 16)
    cuts = (None, "2024-01-15 00:00:00", "2024-01-25 00:00:00", "2024-02-01 00:00:00")
    for low, high in zip(cuts, cuts[1:]):
        events = t.events.where(F.lit(True) if low is None else F.col("ts") >= F.lit(low).cast("timestamp_ntz"))
        if high != cuts[-1]:
            events = events.where(F.col("ts") < F.lit(high).cast("timestamp_ntz"))
        table.upsert(f"until-{high[:10]}", _household_delta(events), ["monthly_income_ksh", "household_size"],
                     ["ts", "event_id"], F.lit(high).cast("timestamp_ntz"))
    return table.read()


# ------------------------------------------------------- G4-G8 from a state

GOLD_SINCE = "2000-01-01 00:00:00"   # orders from here on arrive as the delta


def _long_sql(name: str, body: str, key: str | None) -> str:
    """One gold table as (gold, county, measure, value)."""
    columns = "COLUMNS(*)" if key is None else f"COLUMNS(* EXCLUDE ({key}))"
    county = "CAST(NULL AS VARCHAR)" if key is None else "county"
    return (f"SELECT '{name}' AS gold, {county} AS county, measure, value FROM ("
            f"SELECT {'' if key is None else key + ', '}CAST({columns} AS DOUBLE) FROM ({body})) "
            f"UNPIVOT INCLUDE NULLS (value FOR measure IN ({columns}))")


GOLD_BODIES = {"gold_executive_summary": EXECUTIVE_SQL, "gold_county_performance": COUNTY_SQL,
               "gold_donor_health_impact": HEALTH_SQL, "gold_donor_environment_impact": ENVIRONMENT_SQL,
               "gold_donor_gender_impact": GENDER_SQL}


def gold_long_sql(fact: str) -> str:
    parts = [_long_sql(n, b, None if n == "gold_executive_summary" else "county") for n, b in GOLD_BODIES.items()]
    return households_sql(fact) + "\nUNION ALL\n".join(parts)


def _melt(df, *ids):
    """Every other column as a row (measure, value); one pass over the row, no copies of the input."""
    pairs = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in df.columns if c not in ids]
    return df.select(*ids, F.inline(F.array(*pairs)))


def gold_long(tables):
    """The gold tables as one long table (gold, county, measure, value)."""
    out = None
    for name, df in tables.items():
        if "county" not in df.columns:
            df = df.withColumn("county", F.lit(None).cast("string"))
        one = _melt(df, "county").select(F.lit(name).alias("gold"), "county", "measure", "value")
        out = one if out is None else out.unionByName(one)
    return out


@register("gold_incremental", gold_long_sql("fact_adoptions_multi"), measures=("value",), scale=6, ops="G4 G5 G6 G7 G8 S11")
def q_gold_incremental(t):
    """All gold tables from a stored state: old adoptions once, then the newer ones as a delta (writes while it is built)."""
    s = t.star
    old, new = (s.order_adoptions_between(None, GOLD_SINCE), s.order_adoptions_between(GOLD_SINCE, None))
    state = lambda a: gold_state.adoption_state(a, s.programme_households, s.dim_geography, s.dim_product)
    table = gold_state.create(state(old), scratch_path(t.spark, "gold-state"), 16)
    gold_state.add(table, "delta-1", state(new))
    return gold_long(gold_state.GoldTables(table.read(), s.dim_household, s.dim_geography).all())


# ------------------------------------------------------- S11 between runs

EXTRACT_AT = ("2024-01-10 12:00:00", "2024-01-20 12:00:00", "2024-02-02 00:00:00")


def _as_of(rows, at):
    """A changing table as it stood: rows created until then, changes until then."""
    then = F.lit(at).cast("timestamp_ntz")
    return rows.where(F.col("created_ts") <= then).withColumn(
        "modified_ts", F.when(F.col("modified_ts") <= then, F.col("modified_ts")).otherwise(F.col("created_ts")))


@register("extract_runs", ", " + ",\n".join(f"""v{i} AS (
  SELECT transaction_id, CASE WHEN modified_ts <= TIMESTAMP '{at}' THEN modified_ts ELSE created_ts END AS version_ts
  FROM fact_transactions WHERE created_ts <= TIMESTAMP '{at}')""" for i, at in enumerate(EXTRACT_AT)) + """
SELECT transaction_id, version_ts, 0 AS run FROM v0
UNION ALL SELECT transaction_id, version_ts, 1 FROM v1 ANTI JOIN v0 USING (transaction_id, version_ts)
UNION ALL SELECT transaction_id, version_ts, 2 FROM v2 ANTI JOIN v1 USING (transaction_id, version_ts)
""", ops="S11")
def q_extract_runs(t):
    """Three extracts over a growing, changing table: each version of a row is delivered once (writes while it is built)."""
    rows = t.star.fact_transactions.select("transaction_id", "household_key", "created_ts", "modified_ts")
    job = extract.Extract(t.spark, scratch_path(t.spark, "extract"), "transaction_id", window="LAST_N_DAYS:3")
    for at in EXTRACT_AT:
        job.run(_as_of(rows, at), dt.datetime.fromisoformat(at))
    return job.delivered().select("transaction_id", "version_ts", "run")


# ------------------------------------------------------- R1 resumed

# What stands for the contents of a long output: its rows, the sums of its numbers and of its texts' lengths.
_NUMBERS = {
    "fact_adoptions": ("adoption_key", "household_key", "product_key", "geography_key", "adoption_date_key", "subsidy_amount",
                       "actual_price_paid", "usage_intensity", "baseline_weekly_fuel_cost_ksh"),
    "silver_households": ("household_key", "gps_latitude", "gps_longitude", "head_age", "household_size", "children_under_18",
                          "monthly_income_ksh", "elderly_over_60"),
    "silver_impact_calculations": ("household_key", "product_key", "co2_avoided_annual", "carbon_credit_value_usd",
                                   "mortality_reduction", "dalys_avoided", "annual_fuel_savings_ksh",
                                   "time_saved_hours_annual", "healthcare_savings_annual_ksh"),
}
_TEXTS = {"fact_adoptions": ("payment_method",),
          "silver_households": ("household_id", "county", "urban_rural", "vulnerability_factors", "income_bracket", "family_type",
                                "age_group"),
          "silver_impact_calculations": ("county", "product_type", "adoption_category")}


def _sums_sql(name: str, body: str) -> str:
    sums = [("rows", "COUNT(*)"), *[(c, f"SUM({c})") for c in _NUMBERS[name]], *[(c, f"SUM(length({c}))") for c in _TEXTS[name]]]
    columns = ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in sums)
    return (f"SELECT '{name}' AS output, CAST(NULL AS VARCHAR) AS key, measure, value FROM "
            f"(SELECT {columns} FROM ({body})) UNPIVOT INCLUDE NULLS (value FOR measure IN (COLUMNS(*)))")


def _contents_sql() -> str:
    from .oracle import star
    from .registry import REGISTRY
    parts = [_sums_sql("fact_adoptions", star("SELECT * FROM fact_adoptions")),
             *[_sums_sql(n, REGISTRY[n].sql) for n in ("silver_households", "silver_impact_calculations")]]
    for name in ("silver_adoption_metrics", *GOLD_BODIES):
        body = REGISTRY[name].sql
        key = {"gold_executive_summary": None}.get(name, "county")
        if name == "silver_adoption_metrics":
            body = f"SELECT county || '/' || urban_rural AS county, * EXCLUDE (county, urban_rural) FROM ({body})"
        parts.append(f"SELECT gold AS output, county AS key, measure, value FROM ({_long_sql(name, body, key)})")
    return "\nUNION ALL\n".join(f"SELECT output, key, measure, value FROM ({p})" for p in parts)


def _sums(name, df):
    cols = [F.count(F.lit(1)).cast("double").alias("rows"), *[F.sum(c).cast("double").alias(c) for c in _NUMBERS[name]],
            *[F.sum(F.length(c)).cast("double").alias(c) for c in _TEXTS[name]]]
    return _melt(df.agg(*cols)).select(
        F.lit(name).alias("output"), F.lit(None).cast("string").alias("key"), "measure", "value")


@register("refresh_resumed", _contents_sql(), measures=("value",), scale=6, ops="R1 Q13", raw_sql=True)
def q_refresh_resumed(t):
    """A run that ends early and is taken up again: the contents of every output (writes while it is built)."""
    from . import refresh
    out = scratch_path(t.spark, "refresh-resumed")
    first = ("fact_adoptions", "silver_households", "silver_impact_calculations", "gold_executive_summary")
    refresh.Graph(t.spark, t.sf_dir, out, {n: refresh.OUTPUTS[n] for n in first}).run()
    graph = refresh.Graph(t.spark, t.sf_dir, out)
    graph.run()
    contents = None
    for name in _NUMBERS:
        one = _sums(name, graph.read(name))
        contents = one if contents is None else contents.unionByName(one)
    area = graph.read("silver_adoption_metrics").withColumn("county", F.concat("county", F.lit("/"), "urban_rural")).drop("urban_rural")
    rest = gold_long({"silver_adoption_metrics": area, **{n: graph.read(n) for n in GOLD_BODIES}})
    return contents.unionByName(rest.select(F.col("gold").alias("output"), F.col("county").alias("key"), "measure", "value"))
