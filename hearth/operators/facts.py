"""Fact loads (B4, B5, B7), ledger expansion (B9) and monthly impact."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import is_adopted
from ..functions.dates import chained_add_months, date_key, parse_date
from ..functions.impact import DEFAULT_IMPACT, ImpactCoefficients, impact_columns
from .profile import first_product_per_type

UNDATED = -2_000_000_000   # stands before every month: adoptions without a date


def load_adoptions(households_raw: DataFrame, households: DataFrame,
                   products: DataFrame, geography: DataFrame) -> DataFrame:
    """F8 -> natural-key lookups (J2) -> product by type (left, A10) -> date key."""
    adopted = households_raw.where(is_adopted())
    hk = households.select("household_key", "household_id")
    pk = first_product_per_type(products)
    gk = geography.select("geography_key", "county")
    j = (adopted.join(hk, "household_id")
         .join(pk, "product_type", "left")
         .join(gk, "county"))
    return j.select(
        "household_key", "product_key", "geography_key",
        date_key(F.col("adoption_date")).alias("adoption_date_key"),
        "payment_method", "subsidy_amount", "usage_intensity",
        "baseline_cooking_method", "baseline_fuel_type",
        F.col("cooking_hours_per_day").alias("baseline_cooking_hours_per_day"),
        F.col("weekly_fuel_cost_ksh").alias("baseline_weekly_fuel_cost_ksh"),
        F.lit(500).cast("decimal(10,2)").alias("actual_price_paid"))


def load_transactions(transactions_raw: DataFrame, households: DataFrame,
                      products: DataFrame) -> DataFrame:
    """Left lookups, date key from text, rename, then drop rows without a household or a
    readable date (J7)."""
    hk = households.select("household_key", "household_id")
    pk = first_product_per_type(products)
    j = (transactions_raw.join(hk, "household_id", "left")
         .join(pk, "product_type", "left"))
    return (j.select("transaction_id", "household_key", "product_key",
                     date_key(parse_date(F.col("date"))).alias("transaction_date_key"),
                     "amount_ksh", F.col("type").alias("transaction_type"),
                     "payment_method", "status")
            .dropna(subset=["household_key", "transaction_date_key"]))


def load_prices(prices_raw: DataFrame) -> DataFrame:
    """Price rows with their date key; a row whose date is unreadable has none."""
    return prices_raw.select(
        date_key(parse_date(F.col("date"))).alias("date_key"), "price_per_ton_usd", "market_type", "standard",
        "verification_status", "volume_traded_tons", "kenya_premium_pct")


def load_routes(routes_raw: DataFrame, geography: DataFrame) -> DataFrame:
    """Geography by county (left), then drop unmapped routes."""
    gk = geography.select("geography_key", "county")
    return (routes_raw.join(gk, "county", "left")
            .drop("county").dropna(subset=["geography_key"]))


def adoption_ledger(adoptions: DataFrame, purchase: int = 500, subsidy: int = 300,
                    installment: int = 100) -> DataFrame:
    """Each adoption expanded to its ledger rows in one ``explode``.

    One purchase; a subsidy unless fully subsidised; ``n_installments``
    chained monthly payments when on credit; an optional maintenance visit.
    The random draws of the original generator are input columns here:
    ``n_installments``, ``maintenance_months`` (NULL = none), ``maintenance_amount``; the
    status of a payment and the channel of a maintenance visit follow from the key.
    Donors pay subsidies and installments come by mobile money. ``product_type`` is
    carried where the adoptions have it.
    """
    key = F.col("adoption_key")
    d = F.col("adoption_date")
    pay = F.col("payment_method")
    kind = "array<struct<type:string,date:date,amount_ksh:int,payment_method:string,status:string>>"
    none = F.array().cast(kind)

    def entry(t, dt, amt, method, status=F.lit("completed")):
        return F.struct(F.lit(t).alias("type"), dt.alias("date"), amt.cast("int").alias("amount_ksh"),
                        method.alias("payment_method"), status.alias("status"))

    def paid(i):  # 17, 2 and 1 of 20 payments are completed, pending and failed
        at = (key + i) % 20
        return F.when(at < 17, "completed").when(at < 19, "pending").otherwise("failed")

    payments = F.transform(
        F.sequence(F.lit(1), F.col("n_installments")),
        lambda i: entry("payment", chained_add_months(d, i), F.lit(installment), F.lit("mobile_money"), paid(i)))
    rows = F.concat(
        F.array(entry("purchase", d, F.lit(purchase), pay)),
        F.when(pay != "Full Subsidy", F.array(entry("subsidy", d, F.lit(subsidy), F.lit("donor_fund"))))
         .otherwise(none),
        F.when(pay == "Credit", payments)
         .otherwise(none),
        F.when(F.col("maintenance_months").isNotNull(),
               F.array(entry("maintenance", F.add_months(d, F.col("maintenance_months")),
                             F.col("maintenance_amount"),
                             F.when(key % 2 == 0, "cash").otherwise("mobile_money"))))
         .otherwise(none),
    )
    extra = [c for c in ("product_type",) if c in adoptions.columns]
    return (adoptions.select("adoption_key", "household_key", *extra,
                             F.posexplode(rows).alias("seq", "e"))
            .select(F.concat(F.lit("TRX"), key.cast("string"), F.lit("-"), F.col("seq").cast("string"))
                    .alias("transaction_id"), "adoption_key", "household_key", *extra, "seq", "e.type",
                    F.col("e.date").alias("date"), "e.amount_ksh", "e.payment_method", "e.status"))


def installment_schedule(adoptions: DataFrame) -> DataFrame:
    """Due dates of credit installments, month offsets chained."""
    credit = adoptions.where(F.col("payment_method") == "Credit")
    return (credit.select("adoption_key", "adoption_date",
                          F.explode(F.sequence(F.lit(1), F.col("n_installments")))
                          .alias("installment_no"))
            .select("adoption_key", "installment_no",
                    chained_add_months(F.col("adoption_date"), F.col("installment_no"))
                    .alias("due_date")))


def impact_monthly(adoptions: DataFrame, products: DataFrame, geography: DataFrame,
                   months: int = 12, coef: ImpactCoefficients = DEFAULT_IMPACT,
                   members: DataFrame | None = None) -> DataFrame:
    """Household-product-month grain.

    The reference defines the grain but no formula; this plan's rule is the
    annual measure / 12 for each of the ``months`` months from the adoption
    month. Every measure but fuel is (per-product constant) x usage, and the
    product is a grouping key, so the rows carry only sum(usage) and
    sum(weekly fuel x usage); the product join and the multiplications run
    after the aggregation, on one row per stretch of equal months.
    Adoptions without a county drop out first (left semi join), as in the
    silver impact view.

    Plan: adoptions are first reduced per (household, product, start month)
    with map-side combine, so a hot household costs one partial row per
    start month and map task. Those rows are hash-partitioned on (household,
    product). There each start month is two events, its begin and its end
    ``months`` later; a window sums the starts of the last ``months`` months
    at every event, and what it gives holds until the next event. These
    stretches meet their product and are written out month by month last, as
    a stream: no task keeps a table of expanded rows, and what it sorts is two
    events per reduced row. A (household, product) holds at most one row per
    distinct start month. Adoptions without a date have one row, whose month
    is unknown, with all their ``months`` months in it.

    With ``members`` (household_key, geography_key: the programme's households)
    the adoptions carry no county; they are reduced first and the reduced rows
    meet their household, so a hot household never reaches a join row by row.
    """
    u = F.col("usage_intensity")
    known = geography.select("geography_key")
    f = adoptions if members is not None else adoptions.join(known, "geography_key", "left_semi")
    by = ["household_key", "product_key"] + ([] if members is not None else ["geography_key"])
    pre = (f.groupBy(*by, F.trunc(F.col("adoption_date"), "month").alias("start_month"))
           .agg(F.sum(u).alias("su"),
                F.sum(F.col("baseline_weekly_fuel_cost_ksh") * u).alias("sfu"),
                F.count(F.lit(1)).alias("n"), F.max(u).alias("mx")))
    if members is not None:
        pre = pre.join(members.join(known, "geography_key", "left_semi"), "household_key")
    # Sums of sums keep the first-level types, so the decimal arithmetic below
    # (and its exactness) is the same as summing the adoption rows directly.
    su_type = pre.schema["su"].dataType.simpleString()
    sfu_type = pre.schema["sfu"].dataType.simpleString()
    undated = F.col("start_month").isNull()
    begins = F.col("after") == 0
    times = lambda name, kind: F.when(begins & undated, (F.col(name) * months).cast(kind)).when(begins, F.col(name))
    events = (pre.repartition("household_key", "product_key")
              .withColumn("after", F.explode(F.when(undated, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(months)))))
              .select("household_key", "product_key",
                      F.when(undated, UNDATED).otherwise(F.year("start_month") * 12 + F.month("start_month") - 1 + F.col("after"))
                      .alias("at"),
                      F.when(begins, F.col("geography_key")).alias("geography_key"),
                      times("su", su_type).alias("su"), times("sfu", sfu_type).alias("sfu"),
                      times("n", "bigint").alias("n"), F.when(begins, F.col("mx")).alias("mx")))
    w = Window.partitionBy("household_key", "product_key").orderBy("at")
    active = w.rangeBetween(1 - months, Window.currentRow)
    # of rows at the same month the last one has the next month's begin; a stretch without a start is none
    stretches = (events.select("household_key", "product_key", "at", F.lead("at").over(w).alias("until"),
                               F.min("geography_key").over(active).alias("geography_key"),
                               F.sum("su").over(active).cast(su_type).alias("su"),
                               F.sum("sfu").over(active).cast(sfu_type).alias("sfu"),
                               F.sum("n").over(active).alias("active_adoptions"),
                               F.max("mx").over(active).cast("double").alias("stove_stacking_ratio"))
                 .where(F.col("active_adoptions").isNotNull()
                        & (F.col("until").isNull() | (F.col("until") > F.col("at")))))
    p = products.select("product_key", "carbon_reduction_tons_year", "pm25_emissions_mg_m3")
    m = impact_columns(F.col("carbon_reduction_tons_year"), F.col("pm25_emissions_mg_m3"),
                       F.col("su"), F.lit(0), coef)
    fuel = F.col("sfu") * F.lit(coef.fuel_weeks_per_year)
    if coef.fuel_savings_factor != 1.0:
        fuel = fuel * F.lit(Decimal(str(coef.fuel_savings_factor)))
    per12 = lambda c: c.cast("double") / 12
    month = F.col("month")
    return stretches.join(p, "product_key").select(
        "household_key", "product_key", "geography_key",
        F.when(F.col("at") == UNDATED, F.array(F.lit(None).cast("int")))
        .otherwise(F.sequence(F.col("at"), F.col("until") - 1)).alias("stretch"),
        per12(m["mortality_reduction"]).alias("mortality_reduction"),
        per12(m["co2_avoided_annual"] * F.lit(Decimal(str(coef.trees_per_ton))))
        .alias("trees_saved_equivalent"),
        per12(F.col("pm25_emissions_mg_m3") * F.col("su")).alias("pm25_reduced"),
        per12(m["co2_avoided_annual"]).alias("co2_avoided_tons"),
        per12(m["dalys_avoided"]).alias("dalys_avoided"),
        per12(fuel).alias("fuel_cost_savings_ksh"),
        per12(m["time_saved_hours_annual"]).alias("time_saved_hours"),
        per12(m["healthcare_savings_annual_ksh"]).alias("healthcare_savings_ksh"),
        "active_adoptions", "stove_stacking_ratio"
    ).withColumn("month", F.explode("stretch")).select(
        "household_key", "product_key", "geography_key",
        ((month - F.pmod(month, F.lit(12))) / 12 * 100 + F.pmod(month, F.lit(12)) + 1).cast("int").alias("month_key"),
        "mortality_reduction", "trees_saved_equivalent", "pm25_reduced", "co2_avoided_tons", "dalys_avoided",
        "fuel_cost_savings_ksh", "time_saved_hours", "healthcare_savings_ksh", "active_adoptions", "stove_stacking_ratio")
