"""R1 end to end on sf0.001, and the streaming incremental refresh."""

import datetime as dt
from decimal import Decimal

from hearth.plans import refresh
from hearth.session import scratch_path
from hearth.streaming import incremental as inc
from tests.conftest import SF001


def test_full_refresh_run(spark):
    out = scratch_path(spark, "refresh-test")
    r = refresh.run(spark, SF001, out)
    assert r["success"]
    assert r["rows"]["gold_executive_summary"] == 1
    assert r["rows"]["silver_households"] <= spark.read.parquet(f"{SF001}/customer.parquet").count()
    assert r["checks"]["gold_totals_match"] == 1
    audit = spark.read.parquet(f"{out}/run_audit").collect()
    assert len(audit) == 1 and audit[0].success


def test_stream_upsert(spark):
    base_dir = scratch_path(spark, "stream-table")
    src = scratch_path(spark, "stream-src")
    ck = scratch_path(spark, "stream-ck")
    spark.createDataFrame([(1, Decimal("10"), 3), (2, Decimal("20"), 4)],
                          "k long, income decimal(12,2), size int").write.parquet(f"{base_dir}/v=0")
    schema = "k long, ts timestamp, income decimal(12,2), size int"
    spark.createDataFrame([(2, dt.datetime(2024, 1, 1), Decimal("21"), None),
                           (3, dt.datetime(2024, 1, 1), Decimal("30"), 2)], schema).write.parquet(src + "/a")
    q = inc.stream_upsert(spark, src + "/*", schema, base_dir, "k", ["income", "size"], ["ts"], ck)
    q.awaitTermination(120)
    got = {r.k: (r.income, r.size) for r in inc.latest_version(spark, base_dir).collect()}
    assert got == {1: (Decimal("10.00"), 3), 2: (Decimal("21.00"), None), 3: (Decimal("30.00"), 2)}


def test_stream_merge(spark):
    """Micro-batches rewrite the ranges they touch; a batch that is run again changes nothing."""
    from hearth.sources.ranges import RangeTable
    base = spark.range(200).selectExpr("id as k", "cast(id as decimal(12,2)) as income", "cast(id % 9 as int) as size")
    table = RangeTable.create(base, scratch_path(spark, "stream-ranges"), "k", 8)
    src, schema = scratch_path(spark, "merge-src"), "k long, ts timestamp, income decimal(12,2), size int"
    for name, rows in (("a", [(2, dt.datetime(2024, 1, 1), Decimal("21"), None), (2, dt.datetime(2024, 1, 2), Decimal("22"), 5)]),
                       ("b", [(500, dt.datetime(2024, 1, 3), Decimal("30"), 2)])):
        spark.createDataFrame(rows, schema).write.parquet(f"{src}/{name}")
        inc.stream_merge(spark, src + "/*", schema, table, ["income", "size"], ["ts"], f"{table.root}/checkpoint").awaitTermination(120)
    got = {r.k: (r.income, r.size) for r in table.read().collect()}
    assert len(got) == 201 and got[2] == (Decimal("22.00"), 5) and got[500] == (Decimal("30.00"), 2) and got[3] == (Decimal("3.00"), 3)
    again = spark.createDataFrame([(2, dt.datetime(2025, 1, 1), Decimal("99"), 1)], schema)
    table.upsert("stream-0", again, ["income", "size"], ["ts"])
    assert {r.k: r.income for r in table.read().collect()}[2] == Decimal("22.00")


def test_stream_upsert_ignores_incomplete_version(spark):
    """A batch that died half way leaves a folder without _SUCCESS: nobody reads it."""
    import os
    base_dir = scratch_path(spark, "stream-table")
    spark.createDataFrame([(1, Decimal("10"), 3)], "k long, income decimal(12,2), size int") \
        .write.parquet(f"{base_dir}/v=0")
    os.makedirs(f"{base_dir}/v=1")
    with open(f"{base_dir}/v=1/part-00000.parquet", "wb") as fh:
        fh.write(b"half written")
    assert inc.complete_versions(spark, base_dir) == [0]
    assert [r.k for r in inc.latest_version(spark, base_dir).collect()] == [1]
    # the retried batch 0 reads v=0 and replaces the broken v=1
    src = scratch_path(spark, "stream-src")
    ck = scratch_path(spark, "stream-ck")
    schema = "k long, ts timestamp, income decimal(12,2), size int"
    spark.createDataFrame([(2, dt.datetime(2024, 1, 1), Decimal("20"), 1)], schema) \
        .write.parquet(src + "/a")
    q = inc.stream_upsert(spark, src + "/*", schema, base_dir, "k", ["income", "size"], ["ts"], ck)
    q.awaitTermination(120)
    assert inc.complete_versions(spark, base_dir) == [0, 1]
    assert sorted(r.k for r in inc.latest_version(spark, base_dir).collect()) == [1, 2]


def test_stream_incremental_extract(spark):
    src = scratch_path(spark, "inc-src")
    sink = scratch_path(spark, "inc-sink")
    ck = scratch_path(spark, "inc-ck")
    schema = "id int, created_ts timestamp_ntz, modified_ts timestamp_ntz"
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 25)),
                           (2, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))], schema).write.parquet(src)
    q = inc.stream_incremental_extract(spark, src, schema, "2024-01-20 00:00:00", sink, ck)
    q.awaitTermination(120)
    assert [r.id for r in spark.read.parquet(sink).collect()] == [1]


def test_allocation_report_csv(spark):
    from hearth.plans import allocation_report
    out = scratch_path(spark, "alloc-report")
    r = allocation_report.run(spark, SF001, out)
    rec = spark.read.option("header", True).csv(r["recommendations"])
    assert rec.count() == 6
    alloc = spark.read.option("header", True).csv(r["allocations"])
    assert alloc.select("budget_usd", "objective").distinct().count() == 6
    assert alloc.count() == 6 * 25


def test_cli_list(capsys):
    from hearth.__main__ import main
    assert main(["list"]) == 0
    assert "gold_county_performance" in capsys.readouterr().out


# ------------------------------------------------------------ resuming
def contents(graph):
    return {n: sorted(map(str, graph.read(n).collect())) for n in refresh.OUTPUTS}


def test_a_killed_run_is_taken_up_again(spark, monkeypatch):
    out = scratch_path(spark, "refresh-killed")
    make, calls = refresh.Graph.make, []

    def dies(self, name):
        if name == "gold_donor_health_impact":
            raise RuntimeError("killed")
        calls.append(name)
        return make(self, name)

    monkeypatch.setattr(refresh.Graph, "make", dies)
    try:
        refresh.run(spark, SF001, out)
        raise AssertionError("the run should have died")
    except RuntimeError as e:
        assert str(e) == "killed"
    first, calls[:] = list(calls), []
    monkeypatch.setattr(refresh.Graph, "make", lambda self, name: (calls.append(name), make(self, name))[1])
    result = refresh.run(spark, SF001, out)
    assert result["success"] and sorted(result["made"]) == sorted(calls)
    assert not set(first) & set(calls) and set(first) | set(calls) == set(refresh.OUTPUTS)
    assert [r.success for r in spark.read.parquet(f"{out}/run_audit").orderBy("started_at").collect()] == [False, True]
    monkeypatch.setattr(refresh.Graph, "make", make)
    whole = scratch_path(spark, "refresh-whole")
    refresh.run(spark, SF001, whole)
    assert contents(refresh.Graph(spark, SF001, out)) == contents(refresh.Graph(spark, SF001, whole))


def test_nothing_is_made_twice_and_half_written_outputs_are_remade(spark):
    from hearth.sources import storage
    out = scratch_path(spark, "refresh-again")
    assert sorted(refresh.run(spark, SF001, out)["made"]) == sorted(refresh.OUTPUTS)
    assert refresh.run(spark, SF001, out)["made"] == []
    graph = refresh.Graph(spark, SF001, out)
    at, fs = storage._fs(spark, f"{graph._path('gold_checks')}/_SUCCESS")
    fs.delete(at, False)
    assert refresh.run(spark, SF001, out)["made"] == ["gold_checks"]


def test_a_changed_table_remakes_what_depends_on_it(spark):
    import os
    import shutil
    sf = scratch_path(spark, "tables").removeprefix("file:")
    os.makedirs(sf)
    for t in ("region", "nation", "customer", "part", "orders"):
        shutil.copy(f"{SF001}/{t}.parquet", f"{sf}/{t}.parquet")
    out = scratch_path(spark, "refresh-changed")
    refresh.run(spark, sf, out)
    fewer = spark.read.parquet(f"{SF001}/part.parquet").where("p_partkey < 150")
    fewer.coalesce(1).write.parquet(f"{sf}/part2")
    os.replace(next(f"{sf}/part2/{n}" for n in os.listdir(f"{sf}/part2") if n.endswith(".parquet")), f"{sf}/part.parquet")
    made = refresh.run(spark, sf, out)["made"]
    assert "silver_households" not in made and "household_checks" not in made
    assert {"fact_adoptions", "silver_impact_calculations", "gold_county_performance", "gold_checks"} <= set(made)
