"""Driver tables -> the programme's star schema.

The driver ships TPC-H-shaped tables; these adapters derive the household,
product, geography, adoption, transaction, route and price tables from them
with integer and DECIMAL arithmetic only, so any engine computes the same
values. Each property is a lazy DataFrame; nothing is materialised here.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import vulnerability_factors
from ..functions.dates import date_key

# Driver part type -> programme product type.
PRODUCT_TYPE_OF_PART_TYPE = {
    "ECONOMY": "charcoal_stove",
    "STANDARD": "charcoal_stove",
    "LARGE": "firewood_stove",
    "MEDIUM": "firewood_stove",
    "PROMO": "pellet_stove",
    "SMALL": "solar_lantern",
}
# Payment methods and transaction channels by code.
PAYMENT_METHODS = ("Cash", "Mobile Money", "Credit", "Full Subsidy")
TERRAIN_TYPES = ("flat", "hilly", "mixed")
# Cooking methods and fuels before adoption, by code.
COOKING_METHODS = ("Three-stone fire", "Charcoal stove", "Kerosene", "LPG", "Electric")
FUEL_TYPES = ("Charcoal", "Firewood", "Kerosene", "LPG", "Mixed")


def _dec(x) -> Column:
    return F.lit(Decimal(str(x)))


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default) if default is not None else expr


def _order_columns(o_orderkey: Column, products: Column) -> dict[str, Column]:
    """Adoption attributes that are functions of the order key and the size of the catalogue."""
    k = o_orderkey
    cols = {
        "product_key": (k % products).cast("bigint"),
        "payment_method": _case(k % 4, dict(enumerate(PAYMENT_METHODS))),
        "subsidy_amount": (k % 4).cast("decimal(10,2)"),
        "actual_price_paid": F.lit(500).cast("decimal(10,2)"),
        "usage_intensity": ((k % 101).cast("decimal(5,2)") * _dec("0.01")).cast("decimal(3,2)"),
        "baseline_weekly_fuel_cost_ksh": (k % 1500).cast("decimal(10,2)"),
    }
    return {name: c.alias(name) for name, c in cols.items()}


class StarSchema:
    def __init__(self, tables):
        self.t = tables

    # ------------------------------------------------------------ dimensions
    @cached_property
    def dim_geography(self) -> DataFrame:
        n, r = self.t.nation, self.t.region
        k = F.col("n_nationkey")
        return (n.join(r, n.n_regionkey == r.r_regionkey)
                .select(k.cast("bigint").alias("geography_key"),
                        F.col("n_name").alias("county"),
                        F.col("r_name").alias("region"),
                        (F.lit(1000000) + F.lit(50000) * k).cast("int").alias("population"),
                        (F.lit(1000) + F.lit(250) * k).cast("decimal(10,2)").alias("area_sq_km"),
                        (F.lit(15) + _dec("2.5") * k).cast("decimal(5,2)").alias("poverty_rate"),
                        (F.lit(90) - F.lit(3) * k).cast("decimal(5,2)").alias("electrification_rate")))

    @cached_property
    def dim_household(self) -> DataFrame:
        c, n = self.t.customer, self.t.nation
        k = F.col("c_custkey")
        base = (c.join(n, c.c_nationkey == n.n_nationkey).select(
            k.alias("household_key"),
            F.col("c_name").alias("household_id"),
            F.col("n_name").alias("county"),
            F.when(k % 5 < 2, "Urban").otherwise("Rural").alias("urban_rural"),
            ((k % 111).cast("decimal(10,6)") * _dec("0.1") - _dec("5.5")).cast("decimal(10,6)").alias("gps_latitude"),
            (_dec("33.0") + (k % 97).cast("decimal(10,6)") * _dec("0.1")).cast("decimal(10,6)").alias("gps_longitude"),
            F.when(k % 2 == 0, "Female").otherwise("Male").alias("head_gender"),
            (F.lit(10) + k % 97).cast("int").alias("head_age"),
            F.when(k % 7 == 5, "Widowed").when(k % 7 == 6, "Divorced")
             .when(k % 7 >= 3, "Single").otherwise("Married").alias("marital_status"),
            (k % 23).cast("int").alias("household_size"),
            (k % 6).cast("int").alias("children_under_18"),
            (c.c_acctbal.cast("decimal(12,2)") * F.lit(5)).cast("decimal(12,2)").alias("monthly_income_ksh"),
            (k % 20 == 0).alias("has_disability"),
            (F.col("c_mktsegment") == "HOUSEHOLD").alias("control_group"),
        ))
        return (base
                .withColumn("elderly_over_60", F.when(F.col("head_age") > 60, 1).otherwise(0))
                .withColumn("vulnerability_factors", vulnerability_factors()))

    @cached_property
    def dim_product(self) -> DataFrame:
        p = self.t.part
        s = F.col("p_size")
        return p.select(
            F.col("p_partkey").alias("product_key"),
            F.format_string("PRD%05d", F.col("p_partkey")).alias("product_id"),
            _case(F.col("p_type"), PRODUCT_TYPE_OF_PART_TYPE).alias("product_type"),
            F.col("p_name").alias("product_model"),
            (F.lit(20) + s * _dec("0.5")).cast("decimal(5,2)").alias("thermal_efficiency_pct"),
            (s * F.lit(10)).cast("decimal(8,2)").alias("pm25_emissions_mg_m3"),
            (F.lit(2) + s % 4).cast("int").alias("lifespan_years"),
            (F.lit(1) + s % 5).cast("int").alias("tier_rating"),
            (F.lit(10) + s * _dec("0.5")).cast("decimal(10,2)").alias("unit_cost_usd"),
            (s * _dec("0.05")).cast("decimal(5,2)").alias("carbon_reduction_tons_year"),
        )

    @cached_property
    def product_count(self) -> Column:
        """Products in the catalogue, as a scalar subquery.

        Adoptions draw their product as a key modulo this number, so keys must run from 0
        without a gap; a catalogue whose keys do not is refused when the query runs.
        """
        n, key = F.count(F.lit(1)), F.col("p_partkey")
        dense = (n == 0) | ((F.min(key) == 0) & (F.max(key) == n - 1))
        return self.t.part.agg(F.when(dense, F.greatest(n, F.lit(1)))
                               .otherwise(F.raise_error(F.lit("part keys must be 0 to n - 1")).cast("bigint"))).scalar()

    @cached_property
    def dim_date(self) -> DataFrame:
        """The calendar of the facts: every day from the first to the last adoption or transaction."""
        from ..operators import dims
        return dims.dim_date_between(dims.date_bounds((self.fact_adoptions_multi, F.col("adoption_date")),
                                                      (self.fact_transactions, F.col("transaction_date"))))

    # ----------------------------------------------------------------- facts
    def _non_control_orders(self) -> DataFrame:
        c = self.t.customer.where(F.col("c_mktsegment") != "HOUSEHOLD") \
            .select("c_custkey", "c_nationkey")
        return self.t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"))

    def _adoption_rows(self, orders: DataFrame) -> DataFrame:
        k = F.col("o_orderkey")
        d = F.to_date(F.col("o_orderdate"))
        cols = _order_columns(k, self.product_count)
        return orders.select(
            k.alias("adoption_key"),
            F.col("o_custkey").alias("household_key"),
            cols["product_key"],
            F.col("c_nationkey").cast("bigint").alias("geography_key"),
            d.alias("adoption_date"),
            date_key(d).alias("adoption_date_key"),
            cols["payment_method"], cols["subsidy_amount"], cols["actual_price_paid"],
            cols["usage_intensity"], cols["baseline_weekly_fuel_cost_ksh"],
        )

    def first_orders(self, *extra: str) -> DataFrame:
        """First order per customer by (date, key): a partial-aggregated min, no window.

        Only the columns asked for ride in the struct (Catalyst cannot prune
        fields out of an aggregated struct).
        """
        o = self.t.orders
        first = (o.groupBy("o_custkey")
                 .agg(F.min(F.struct("o_orderdate", "o_orderkey", *extra)).alias("f")))
        return first.select("o_custkey", "f.o_orderdate", "f.o_orderkey",
                            *[f"f.{c}" for c in extra])

    @cached_property
    def fact_adoptions(self) -> DataFrame:
        """One adoption per non-control customer: their first order."""
        c = self.t.customer.where(F.col("c_mktsegment") != "HOUSEHOLD") \
            .select("c_custkey", "c_nationkey")
        firsts = self.first_orders().join(c, F.col("o_custkey") == F.col("c_custkey"))
        return self._adoption_rows(firsts)

    @cached_property
    def fact_adoptions_multi(self) -> DataFrame:
        """Every order of a non-control customer: several adoptions per household."""
        return self._adoption_rows(self._non_control_orders())

    @cached_property
    def order_adoptions(self) -> DataFrame:
        """Adoption measures of every order, before any customer is looked up."""
        return self.order_adoptions_between(None, None)

    def order_adoptions_between(self, low: str | None, high: str | None) -> DataFrame:
        """``order_adoptions`` of the orders from ``low`` on and before ``high``; the bounds reach the scan."""
        k = F.col("o_orderkey")
        cols = _order_columns(k, self.product_count)
        orders = self.t.orders
        if low is not None:
            orders = orders.where(F.col("o_orderdate") >= F.lit(low).cast(orders.schema["o_orderdate"].dataType))
        if high is not None:
            orders = orders.where(F.col("o_orderdate") < F.lit(high).cast(orders.schema["o_orderdate"].dataType))
        return orders.select(
            F.col("o_custkey").alias("household_key"), cols["product_key"],
            F.to_date(F.col("o_orderdate")).alias("adoption_date"),
            cols["usage_intensity"], cols["subsidy_amount"], cols["baseline_weekly_fuel_cost_ksh"])

    @cached_property
    def programme_households(self) -> DataFrame:
        """Household and county key of every non-control customer."""
        return (self.t.customer.where(F.col("c_mktsegment") != "HOUSEHOLD")
                .select(F.col("c_custkey").alias("household_key"),
                        F.col("c_nationkey").cast("bigint").alias("geography_key")))

    @cached_property
    def fact_transactions(self) -> DataFrame:
        e = self.t.events
        eid = F.col("event_id")
        d = F.to_date(F.col("ts"))
        return e.select(
            eid.alias("transaction_key"),
            F.concat(F.lit("TRX"), eid.cast("string")).alias("transaction_id"),
            F.col("user_id").alias("household_key"),
            d.alias("transaction_date"),
            date_key(d).alias("transaction_date_key"),
            F.col("value").cast("decimal(12,2)").alias("amount_ksh"),
            F.col("event_type").alias("transaction_type"),
            F.when(eid % 20 == 0, "failed").when(eid % 20 == 1, "pending")
             .otherwise("completed").alias("status"),
            F.col("ts").alias("created_ts"),
            (F.col("ts") + F.make_dt_interval(hours=(eid % 48).cast("int"))).alias("modified_ts"),
        )

    # --------------------------------------------------------- bronze inputs
    @cached_property
    def households_raw(self) -> DataFrame:
        """Survey-shaped household rows carrying natural keys only.

        product_type is 'none' for control or order-less households and NULL
        when the first order is still pending (status 'P').
        """
        h = self.dim_household.drop("household_key")
        fo = self.first_orders("o_orderstatus")
        prod = self.dim_product.select("product_key", "product_type")
        k = F.col("o_orderkey")
        cols = _order_columns(k, self.product_count)
        adopt = (fo.withColumn("product_key", cols["product_key"])
                 .join(prod, "product_key", "left")
                 .select(F.format_string("Customer#%09d", F.col("o_custkey")).alias("household_id"),
                         F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
                          .otherwise(F.col("product_type")).alias("adopted_type"),
                         F.to_date("o_orderdate").alias("adoption_date"),
                         cols["payment_method"], cols["usage_intensity"],
                         cols["subsidy_amount"],
                         _case(k % 5, dict(enumerate(COOKING_METHODS))).alias("baseline_cooking_method"),
                         _case(k % 5, dict(enumerate(FUEL_TYPES))).alias("baseline_fuel_type"),
                         (_dec("1.0") + (k % 9).cast("decimal(2,0)") * _dec("0.5")).cast("decimal(5,2)")
                         .alias("cooking_hours_per_day"),
                         cols["baseline_weekly_fuel_cost_ksh"].alias("weekly_fuel_cost_ksh")))
        j = h.join(adopt, "household_id", "left")
        treated = ~F.col("control_group") & F.col("adoption_date").isNotNull()
        out = j.withColumn("product_type", F.when(treated, F.col("adopted_type")).otherwise(F.lit("none")))
        for name in ("adoption_date", "payment_method", "usage_intensity", "subsidy_amount",
                     "baseline_cooking_method", "baseline_fuel_type", "cooking_hours_per_day",
                     "weekly_fuel_cost_ksh"):
            out = out.withColumn(name, F.when(treated, F.col(name)))
        return out.drop("adopted_type")

    @cached_property
    def transactions_raw(self) -> DataFrame:
        """Ledger-shaped rows with a natural household id; signups have none yet.

        Every 97th date is unreadable, as hand-kept ledgers have them.
        """
        e = self.t.events
        eid = F.col("event_id")
        types = ("charcoal_stove", "firewood_stove", "pellet_stove", "solar_lantern")
        return e.select(
            F.concat(F.lit("TRX"), eid.cast("string")).alias("transaction_id"),
            F.when(F.col("event_type") != "signup",
                   F.format_string("Customer#%09d", F.col("user_id"))).alias("household_id"),
            F.when(eid % 97 == 0, F.lit("not-a-date"))
             .otherwise(F.date_format(F.col("ts"), "yyyy-MM-dd")).alias("date"),
            F.col("value").cast("decimal(12,2)").alias("amount_ksh"),
            F.col("event_type").alias("type"),
            F.when(eid % 3 == 0, "cash").when(eid % 3 == 1, "mobile_money")
             .otherwise("donor_fund").alias("payment_method"),
            F.when(eid % 20 == 0, "failed").when(eid % 20 == 1, "pending")
             .otherwise("completed").alias("status"),
            _case(eid % 4, dict(enumerate(types))).alias("product_type"),
        )

    @cached_property
    def routes_raw(self) -> DataFrame:
        """Delivery routes, one per supplier; suppliers in debit are unmapped."""
        s, n = self.t.supplier, self.t.nation
        k = F.col("s_suppkey")
        return (s.join(n, s.s_nationkey == n.n_nationkey).select(
            F.format_string("RT%04d", k).alias("route_id"),
            F.when(F.col("s_acctbal") < 0, F.lit("UNMAPPED")).otherwise(F.col("n_name")).alias("county"),
            F.concat(F.lit("DC-"), F.col("n_name")).alias("distribution_center"),
            F.concat(F.lit("Route "), k.cast("string")).alias("route_name"),
            (F.lit(5) + k % 50).cast("decimal(10,2)").alias("distance_km"),
            (F.lit(100) + k % 400).cast("int").alias("households_covered"),
            _case(k % 3, dict(enumerate(TERRAIN_TYPES))).alias("terrain_type"),
            (k % 4 != 0).alias("ebike_required"),
            (F.lit(20) + k % 30).cast("int").alias("deliveries_per_month"),
        ))

    @cached_property
    def prices_raw(self) -> DataFrame:
        """Carbon price rows as they are read: one per order, dated by a text day."""
        k = F.col("o_orderkey")
        return self.t.orders.select(
            F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd").alias("date"),
            (_dec("5.00") + (k % 2000).cast("decimal(4,0)") * _dec("0.01")).cast("decimal(10,2)")
            .alias("price_per_ton_usd"),
            F.lit("voluntary").alias("market_type"), F.lit("CCP").alias("standard"),
            F.when(k % 3 < 2, "verified").otherwise("projected").alias("verification_status"),
            (F.lit(10000) + k % 90000).cast("int").alias("volume_traded_tons"),
            (_dec("5.0") + (k % 101).cast("decimal(3,0)") * _dec("0.1")).cast("decimal(5,2)")
            .alias("kenya_premium_pct"))

    @cached_property
    def monthly_prices(self) -> DataFrame:
        """Price series: one row per order month, dated by a text first-of-month."""
        o = self.t.orders
        m = F.trunc(F.to_date("o_orderdate"), "month")
        return (o.groupBy(m.alias("month_start"))
                .agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total_price"),
                     F.count(F.lit(1)).alias("orders"))
                .select(F.date_format("month_start", "yyyy-MM-dd").alias("date"),
                        "total_price", "orders"))
