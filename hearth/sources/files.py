"""Typed CSV and JSON scans, and the CRM extract's boundary cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import clip, coerce, coerce_bool, cut, household_is_valid
from ..functions.dates import date_key, parse_date
from .schemas import DIM_DONOR, RAW_DONORS, conform, struct


class SchemaMismatch(ValueError):
    """A file's columns are not the expected ones: the load is aborted."""


def read_csv(spark: SparkSession, path: str, schema: StructType | str, corrupt: str | None = None,
             multiline: bool = False) -> DataFrame:
    """Header CSV matched by column name; the text ``None`` and empty fields are NULL.

    Columns may stand in any order but must be exactly the expected ones, in every file
    (``SchemaMismatch`` otherwise, or Spark's header check when files differ). Quoted fields
    may hold doubled quotes and, with ``multiline``, line breaks; a file read so is one task,
    so it is set only where a field does hold line breaks, and else large files are split.
    A row that is too short, too long or has an unreadable value keeps what could be read;
    with ``corrupt`` its text is kept in that column, so it can be counted.
    """
    want = struct(schema)
    options = {"header": True, "multiLine": multiline, "quote": '"', "escape": '"'}
    header = spark.read.options(**options).csv(path).columns
    if sorted(header) != sorted(want.fieldNames()):
        raise SchemaMismatch(f"{path}: expected {sorted(want.fieldNames())}, found {sorted(header)}")
    bad = corrupt or "_corrupt_record"
    found = StructType([*[want[c] for c in header], StructField(bad, StringType())])
    df = (spark.read.schema(found).options(**options).option("enforceSchema", False)
          .option("nullValue", "None").option("emptyValue", None).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", bad).csv(path))
    return df.select(*want.fieldNames(), *([bad] if corrupt else []))


def bronze_check(source: str, rows: DataFrame, corrupt: str = "_corrupt_record") -> DataFrame:
    """Load check of one file read with ``corrupt``: rows, corrupt rows, and a warning on none."""
    columns = [c for c in rows.columns if c != corrupt]
    n = F.count(F.lit(1))
    # Spark converts only the columns a query uses, and only those can fail: use them all
    bad = F.count_if(F.col(corrupt).isNotNull() | (F.length(F.to_json(F.struct(*columns))) < 2))
    return rows.agg(
        F.lit(source).alias("source"), n.alias("rows"), bad.alias("corrupt_rows"),
        F.count(columns[0]).alias("first_column_filled"),
        F.when((n == 0) | (bad > 0), "Warning").otherwise("OK").alias("status"))


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV; NULLs written as ``None`` so ``read_csv`` restores them."""
    (df.write.mode("overwrite").option("header", True).option("nullValue", "None")
     .option("escape", '"').csv(path))


def read_json(spark: SparkSession, path: str, schema: StructType | str,
              multiline: bool = True) -> DataFrame:
    """Array-of-objects JSON file(s) with an explicit schema."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


# CRM field -> warehouse column.
CRM_HOUSEHOLD_FIELDS = {
    "Id": "salesforce_id",
    "Household_ID__c": "household_id",
    "County__c": "county",
    "Sub_County__c": "sub_county",
    "Ward__c": "ward",
    "Village__c": "village",
    "Urban_Rural__c": "urban_rural",
    "GPS_Latitude__c": "gps_latitude",
    "GPS_Longitude__c": "gps_longitude",
    "Head_Gender__c": "head_gender",
    "Head_Age__c": "head_age",
    "Household_Size__c": "household_size",
    "Children_Under_18__c": "children_under_18",
    "Monthly_Income__c": "monthly_income_ksh",
    "Control_Group__c": "control_group",
    "LastModifiedDate": "modified_date",
}


def clean_crm_households(raw: DataFrame) -> DataFrame:
    """F2 + F3 + F13: rename CRM fields, drop API metadata, coerce with defaults."""
    df = raw.drop("attributes").withColumnsRenamed(CRM_HOUSEHOLD_FIELDS)
    return df.withColumns({
        "head_age": coerce("head_age", 0, "int"),
        "household_size": coerce("household_size", 1, "int"),
        "children_under_18": coerce("children_under_18", 0, "int"),
        "gps_latitude": F.col("gps_latitude").try_cast("decimal(10,6)"),
        "gps_longitude": F.col("gps_longitude").try_cast("decimal(10,6)"),
        "monthly_income_ksh": coerce("monthly_income_ksh", 0, "decimal(12,2)"),
        "control_group": coerce_bool("control_group"),
    })


# Income cut of the CRM transform.
INCOME_EDGES = (0, 10000, 30000, float("inf"))
INCOME_LABELS = ("Low", "Medium", "High")


def transform_crm_households(raw: DataFrame) -> DataFrame:
    """F5 + F7 on the cleaned extract: rows in range only, with their income cut (0 and below: NULL)."""
    return clean_crm_households(raw).where(household_is_valid()).withColumn(
        "income_bracket", cut("monthly_income_ksh", INCOME_EDGES, INCOME_LABELS))


def crm_extract(households: DataFrame) -> DataFrame:
    """Render household rows the way the CRM API returns them: text fields.

    Ages are unknown for one account in 13 and sizes blank for one in 11, as a
    hand-keyed source would have them.
    """
    k = F.col("household_key")
    return households.select(
        F.to_json(F.struct(F.lit("Account").alias("type"))).alias("attributes"),
        k.cast("string").alias("Id"),
        F.col("household_id").alias("Household_ID__c"),
        F.col("county").alias("County__c"),
        F.concat("county", F.lit("-"), (k % 8).cast("string")).alias("Sub_County__c"),
        F.concat(F.lit("Ward "), (k % 40).cast("string")).alias("Ward__c"),
        F.concat(F.lit("Village "), (k % 400).cast("string")).alias("Village__c"),
        F.col("urban_rural").alias("Urban_Rural__c"),
        F.col("gps_latitude").cast("string").alias("GPS_Latitude__c"),
        F.col("gps_longitude").cast("string").alias("GPS_Longitude__c"),
        F.col("head_gender").alias("Head_Gender__c"),
        F.when(k % 13 == 0, F.lit("unknown")).otherwise(F.col("head_age").cast("string"))
         .alias("Head_Age__c"),
        F.when(k % 11 == 0, F.lit("")).otherwise(F.col("household_size").cast("string"))
         .alias("Household_Size__c"),
        F.col("children_under_18").cast("string").alias("Children_Under_18__c"),
        F.col("monthly_income_ksh").cast("string").alias("Monthly_Income__c"),
        F.when(F.col("control_group"), "true").otherwise("false").alias("Control_Group__c"),
    )


# CRM opportunity field -> adoption column.
CRM_ADOPTION_FIELDS = {
    "Id": "salesforce_id",
    "AccountId": "household_salesforce_id",
    "Product2Id": "product_salesforce_id",
    "CloseDate": "adoption_date",
    "Subsidy_Amount__c": "subsidy_amount",
    "Payment_Method__c": "payment_method",
    "Usage_Intensity__c": "usage_intensity",
    "Baseline_Fuel_Cost__c": "baseline_weekly_fuel_cost_ksh",
}
USAGE_DEFAULT = 0.7    # fixed value: usage where the CRM has none


def clean_crm_adoptions(raw: DataFrame) -> DataFrame:
    """F2 + F13 + F14 + F15: rename, read the date and its key, usage defaulted and clipped to [0, 1]."""
    df = raw.drop("attributes").withColumnsRenamed(CRM_ADOPTION_FIELDS)
    df = df.withColumn("adoption_date", parse_date("adoption_date"))
    return df.withColumns({"adoption_date_key": date_key(F.col("adoption_date")),
                           "usage_intensity": clip(coerce("usage_intensity", USAGE_DEFAULT), 0.0, 1.0)})


def crm_adoption_extract(adoptions: DataFrame) -> DataFrame:
    """Render adoption rows the way the CRM API returns them: text, some usage blank or out of range."""
    k = F.col("adoption_key")
    usage = F.col("usage_intensity").cast("string")
    return adoptions.select(
        F.to_json(F.struct(F.lit("Opportunity").alias("type"))).alias("attributes"),
        k.cast("string").alias("Id"), F.col("household_key").cast("string").alias("AccountId"),
        F.col("product_key").cast("string").alias("Product2Id"),
        F.date_format("adoption_date", "yyyy-MM-dd").alias("CloseDate"),
        F.col("subsidy_amount").cast("string").alias("Subsidy_Amount__c"),
        F.col("payment_method").alias("Payment_Method__c"),
        F.when(k % 13 == 0, F.lit("unknown")).when(k % 17 == 0, F.lit("1.5")).when(k % 19 == 0, F.lit("-2"))
         .otherwise(usage).alias("Usage_Intensity__c"),
        F.col("baseline_weekly_fuel_cost_ksh").cast("string").alias("Baseline_Fuel_Cost__c"))


def write_json_arrays(df: DataFrame, path: str, files: int = 1) -> None:
    """JSON files that each hold one array of objects, as an API or a hand-kept file has them.

    Such a file is one value and is read in one task, so ``files`` should grow with the rows.
    """
    objects = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    (df.select(F.pmod(F.xxhash64(objects), F.lit(files)).alias("file"), objects.alias("o"))
     .groupBy("file").agg(F.array_sort(F.collect_list("o")).alias("o"))
     .select("file", F.concat(F.lit("["), F.array_join("o", ","), F.lit("]")).alias("value"))
     .write.mode("overwrite").partitionBy("file").text(path))


def donor_rows(suppliers: DataFrame, nations: DataFrame) -> DataFrame:
    """Donors derived from suppliers: arrays of priority metrics and preferred counties.

    A donor prefers its own county and the next ones by key; one in seven takes ``All``, one in
    eleven none (an empty array), and one in thirteen has no list at all.
    """
    k = F.col("s_suppkey")
    counties = nations.agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("_counties"))  # 25 rows
    focus = F.element_at(F.array(*[F.lit(x) for x in DONOR_FOCUS]), (k % len(DONOR_FOCUS) + 1).cast("int"))
    metric = F.array(*[F.lit(x) for x in DONOR_METRICS])
    n = F.size("_counties")
    preferred = F.transform(F.sequence(F.lit(0), (k % 3).cast("int")),
                            lambda i: F.element_at("_counties", ((F.col("s_nationkey") + i * 5) % n + 1).cast("int"))["n_name"])
    return (suppliers.withColumn("_counties", counties.scalar()).select(
        F.format_string("DN%06d", k).alias("donor_id"), F.col("s_name").alias("donor_name"),
        F.when(k % 2 == 0, "Foundation").otherwise("Bilateral").alias("donor_type"), focus.alias("focus_area"),
        F.slice(metric, (k % 4 + 1).cast("int"), (k % 3 + 1).cast("int")).alias("priority_metrics"),
        (k * 1000 + 500000).cast("long").alias("funding_available_usd"),
        F.when(k % 4 == 0, "Annual").otherwise("Quarterly").alias("reporting_frequency"),
        F.when(k % 13 == 0, F.lit(None)).when(k % 11 == 0, F.array().cast("array<string>"))
         .when(k % 7 == 0, F.array(F.lit("All"))).otherwise(preferred).alias("preferred_counties"),
        (k % 50 * 1000).cast("long").alias("impact_threshold_households"),
        (F.lit(5) + k % 10).cast("long").alias("cost_per_impact_target")))


# Donor focus areas and priority metrics.
DONOR_FOCUS = ("Health", "Environment", "Gender", "Economic")
DONOR_METRICS = ("lives_saved", "DALYs_avoided", "CO2_avoided_tons", "women_time_saved_hours", "household_savings_ksh", "jobs_created")


def read_donors(spark: SparkSession, path: str) -> DataFrame:
    """The donor files under ``path``, each an array of objects, with their array fields."""
    return spark.read.schema(RAW_DONORS).option("multiLine", True).option("recursiveFileLookup", True).json(path)


def load_donors(spark: SparkSession, path: str) -> DataFrame:
    """Donor JSON array -> the donor dimension's columns (arrays dropped, as loaded)."""
    return conform(read_donors(spark, path), DIM_DONOR, key="donor_key", natural_key="donor_id")


def donor_preferences(donors: DataFrame, geography: DataFrame) -> DataFrame:
    """One row per (donor, county) that the donor prefers; ``All`` means every county.

    The counties of ``All`` come from the geography dimension as one array (a county a row, so
    it is small), which is exploded; named counties are exploded as they are. Donors without a
    preference give no row.
    """
    every = geography.agg(F.array_sort(F.collect_set("county")).alias("c")).scalar()
    wanted = F.when(F.array_contains("preferred_counties", "All"), every).otherwise(F.array_distinct("preferred_counties"))
    return donors.select(
        "donor_id", "focus_area", F.explode(wanted).alias("county"), F.array_contains("preferred_counties", "All").alias("takes_all"),
        F.exists("priority_metrics", lambda m: m.isin("lives_saved", "DALYs_avoided")).alias("values_health"),
        F.size(F.filter("priority_metrics", lambda m: F.length(m) > 12)).alias("long_metrics"))


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Expose frames to SQL as temporary views (lazy; inlined by Catalyst)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
