"""CSV NULL text (T1), upsert semantics (S12/W3), incremental filter, ledger counts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hearth.operators import facts
from hearth.session import scratch_path
from hearth.sources import files, sinks


def test_csv_none_is_null(spark):
    path = scratch_path(spark, "none-csv")
    lines = ["household_id,education_level,product_type,age", "HH1,None,none,30",
             "HH2,,charcoal_stove,", 'HH3,"Primary",None,41']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    df = files.read_csv(spark, path, "household_id string, education_level string, "
                                     "product_type string, age int")
    rows = {r.household_id: r for r in df.collect()}
    assert rows["HH1"].education_level is None and rows["HH1"].product_type == "none"
    assert rows["HH2"].education_level is None and rows["HH2"].age is None
    assert rows["HH3"].product_type is None and rows["HH3"].education_level == "Primary"


def test_csv_is_matched_by_name_and_bad_rows_are_kept(spark):
    path = scratch_path(spark, "odd-csv")
    text = 'county,household_id,age\n"Nairobi, ""west""\nside",HH1,30\nKilifi,HH2\nTana,HH3,old\nLamu,HH4,41'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    schema = "household_id string, county string, age int"
    df = files.read_csv(spark, path, schema, corrupt="bad", multiline=True)
    rows = {r.household_id: r for r in df.collect()}
    assert rows["HH1"].county == 'Nairobi, "west"\nside' and rows["HH1"].age == 30 and rows["HH1"].bad is None
    assert rows["HH2"].county == "Kilifi" and rows["HH2"].age is None and rows["HH2"].bad is not None
    assert rows["HH3"].age is None and rows["HH3"].bad is not None and rows["HH4"].age == 41
    check = files.bronze_check("households", df, corrupt="bad").first()
    assert (check.rows, check.corrupt_rows, check.status) == (4, 2, "Warning")
    with pytest.raises(files.SchemaMismatch):
        files.read_csv(spark, path, "household_id string, county string, income int")


def test_upsert_semantics(spark):
    base = spark.createDataFrame([(1, "a", Decimal("10"), 3), (2, "b", Decimal("20"), 4),
                                  (3, "c", Decimal("30"), 5)],
                                 "k long, name string, income decimal(12,2), size int")
    delta = spark.createDataFrame(
        [(2, dt.datetime(2024, 1, 1), 1, Decimal("21"), 4),
         (2, dt.datetime(2024, 1, 2), 2, Decimal("22"), None),     # latest wins, NULL overwrites
         (3, dt.datetime(2024, 1, 1), 3, Decimal("31"), 6),
         (9, dt.datetime(2024, 1, 1), 4, Decimal("90"), 1)],       # new key
        "k long, ts timestamp, seq long, income decimal(12,2), size int").withColumn("name", F.concat(F.lit("new"), "k"))
    stamp = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    out = {r.k: r for r in sinks.upsert(base, delta, "k", ["income", "size"], ["ts", "seq"], updated_at=stamp).collect()}
    assert out[1].updated_at is None and out[2].updated_at == out[9].updated_at == dt.datetime(2024, 3, 1)
    assert (out[1].income, out[1].size, out[1].change) == (Decimal("10.00"), 3, "unchanged")
    assert (out[2].income, out[2].size, out[2].name, out[2].change) == (Decimal("22.00"), None, "b", "updated")
    assert (out[3].income, out[3].size) == (Decimal("31.00"), 6)
    assert (out[9].income, out[9].name, out[9].change) == (Decimal("90.00"), "new9", "inserted")


def test_latest_per_key_hot_key(spark):
    rows = [(1, i, i * 10) for i in range(3000)] + [(2, 1, 5)]
    d = spark.createDataFrame(rows, "k long, ts long, v long")
    got = {r.k: r.v for r in sinks.latest_per_key(d, "k", ["ts"]).collect()}
    assert got == {1: 29990, 2: 5}


def test_incremental(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 25)),
                                (2, dt.datetime(2024, 1, 21), dt.datetime(2024, 1, 21)),
                                (3, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))],
                               "id int, created_ts timestamp_ntz, modified_ts timestamp_ntz")
    got = sorted(r.id for r in sinks.incremental(df, "2024-01-20 00:00:00").collect())
    assert got == [1, 2]


def test_ledger_row_counts(spark):
    rows = [(1, 1, dt.date(2024, 1, 31), "Credit", 3, 5, 80),
            (2, 2, dt.date(2024, 2, 10), "Full Subsidy", 2, None, 60),
            (3, 3, dt.date(2024, 3, 5), "Cash", 4, None, 70)]
    a = spark.createDataFrame(rows, "adoption_key long, household_key long, adoption_date date, "
                                    "payment_method string, n_installments int, "
                                    "maintenance_months int, maintenance_amount int")
    led = facts.adoption_ledger(a)
    counts = {r.adoption_key: r[1] for r in led.groupBy("adoption_key").count().collect()}
    assert counts == {1: 1 + 1 + 3 + 1, 2: 1, 3: 2}
    pays = [r.date for r in led.where("type = 'payment'").orderBy("seq").collect()]
    assert pays == [dt.date(2024, 2, 29), dt.date(2024, 3, 29), dt.date(2024, 4, 29)]
    total = led.agg(F.sum("amount_ksh")).first()[0]
    assert total == 500 + 300 + 300 + 80 + 500 + 500 + 300


def test_sinks_append_replace_json(spark):
    path = scratch_path(spark, "sink")
    df = spark.createDataFrame([(1, "a", 202401), (2, "b", 202402)], "k int, v string, m int")
    sinks.append(df, path, partition_by=["m"])
    sinks.append(df, path, partition_by=["m"])
    assert spark.read.parquet(path).count() == 4
    assert spark.read.parquet(path).where("m = 202401").count() == 2
    staging = scratch_path(spark, "staging")
    sinks.replace(df, staging)
    sinks.replace(df.limit(1), staging)
    assert spark.read.parquet(staging).count() == 1
    js = scratch_path(spark, "json")
    sinks.export_json(df, js)
    assert sorted(r.k for r in spark.read.json(js).collect()) == [1, 2]
