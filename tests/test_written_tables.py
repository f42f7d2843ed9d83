"""Global order (L4), repeatable appends (S6), gated publication (Q13), pruning (S3) and nested documents."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from hearth.operators import gate, order
from hearth.plans import queries_tables
from hearth.session import scratch_path
from hearth.sources import files, schemas, sinks, storage, warehouse
from hearth.sources.tables import Tables
from tests.conftest import SF001


# ---------------------------------------------------------------- order
def test_global_order_and_ordered_files(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 613).alias("v"))
    path = scratch_path(spark, "ordered")
    order.write_ordered(df, path, [F.col("v").desc(), F.col("id")], 7)
    got = order.ranked(spark.read.parquet(path)).collect()
    want = sorted(((r.v, r.id) for r in df.collect()), key=lambda x: (-x[0], x[1]))
    assert [(r.v, r.id) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert [r["rank"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 5001))
    parts = [n for n in storage.children(spark, path) if n.startswith("part=")]
    assert len(parts) > 3
    ends = [(r.lo, r.hi) for r in spark.read.parquet(path).groupBy("part").agg(F.max("v").alias("lo"), F.min("v").alias("hi"))
            .orderBy("part").collect()]
    assert all(a[1] >= b[0] for a, b in zip(ends, ends[1:]))


def test_the_window_sees_one_row_per_file(spark):
    path = scratch_path(spark, "ordered")
    order.write_ordered(spark.range(100).select("id"), path, [F.col("id")], 4)
    plan = order.ranked(spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window"):]
    assert "Aggregate [part" in below


def test_order_of_nothing(spark):
    path = scratch_path(spark, "ordered")
    order.write_ordered(spark.range(0).select("id"), path, [F.col("id")], 4)
    empty = spark.read.schema("id long, place long, part int").parquet(path)
    assert order.ranked(empty).count() == 0


# ---------------------------------------------------------------- append
def test_append_batch(spark):
    path = scratch_path(spark, "batches")
    with pytest.raises(FileNotFoundError):
        sinks.read_batches(spark, path)
    assert sinks.append_batch(spark.range(3), path, "2024-01-01")
    assert not sinks.append_batch(spark.range(3), path, "2024-01-01")
    assert sinks.append_batch(spark.range(3), path, "2024-01-02")
    spark.range(9).write.parquet(f"{path}/batch=died")
    at, fs = storage._fs(spark, f"{path}/batch=died/_SUCCESS")
    fs.delete(at, False)                                     # a batch whose job did not end
    got = sorted((r.batch, r.id) for r in sinks.read_batches(spark, path).collect())
    assert got == [(b, i) for b in ("2024-01-01", "2024-01-02") for i in range(3)]
    assert sinks.append_batch(spark.range(1), path, "died")
    assert sinks.read_batches(spark, path).count() == 7


# ---------------------------------------------------------------- gate
@pytest.mark.parametrize("measured, want", [
    ((100, 100, 0, 0, 1), []), ((89, 100, 0, 0, 1), ["records"]), ((90, 100, 0, 0, 1), []), ((100, None, 0, 6, 1), ["failures"]),
    ((100, None, 0, 5, 1), []), ((100, None, 5, 0, 1), ["nulls"]), ((100, None, 4, 0, 1), []), ((0, 10, 0, 0, 1), ["records"]),
    ((0, None, 0, 0, 1), []), ((100, 200, 50, 50, 1801), ["duration", "records", "failures", "nulls"])])
def test_thresholds(measured, want):
    rows, expected, nulls, failures, seconds = measured
    assert gate.judge(rows, expected, nulls, failures, seconds, required=2) == want


def test_a_breach_keeps_the_old_table(spark):
    root = scratch_path(spark, "gated")
    rules = gate.Rules(("v",), {"positive": F.col("v") > 0})
    assert gate.current(spark, root) is None
    good = spark.range(1, 101).select(F.col("id").alias("v"))
    assert gate.publish(good, root, "b1", rules, 100, at=dt.datetime(2024, 1, 1)) == []
    bad = spark.range(-50, 51).select(F.col("id").alias("v"))
    assert gate.publish(bad, root, "b2", rules, 100, at=dt.datetime(2024, 1, 2)) == ["failures"]
    assert gate.current(spark, root).agg(F.min("v")).first()[0] == 1
    more = spark.range(1, 121).select(F.col("id").alias("v"))
    assert gate.publish(more, root, "b3", rules, 100, at=dt.datetime(2024, 1, 3)) == []
    assert gate.current(spark, root).count() == 120
    log = {r.batch: r for r in gate.audit(spark, root).collect()}
    assert [log[b].published for b in ("b1", "b2", "b3")] == [True, False, True]
    assert (log["b2"].rows, log["b2"].failures, log["b2"].nulls, log["b2"].breaches) == (101, 51, 0, ["failures"])


def test_measures_cost_no_further_pass(spark):
    """A NULL fails a rule, counts as a missing value, and everything is counted in the writing job."""
    root = scratch_path(spark, "gated")
    rows = spark.createDataFrame([(None,), (1,), (2,)], "v int")
    broken = gate.publish(rows, root, "b", gate.Rules(("v",), {"positive": F.col("v") > 0}))
    assert broken == ["failures", "nulls"] and gate.audit(spark, root).first().nulls == 1


# ---------------------------------------------------------------- pruning
def test_the_calendar_prunes_month_folders(spark):
    root = scratch_path(spark, "star")
    warehouse.write_star(Tables(spark, SF001).star, root, ("dim_geography", "dim_date"), ("fact_adoptions_multi",))
    star = warehouse.WarehouseStar(spark, root)
    df = queries_tables.fiscal_quarters(star, 1997, (2, 3))
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString()
    df.collect()
    scans = _scans(df._jdf.queryExecution().executedPlan())
    months = len([n for n in storage.children(spark, f"{root}/fact_adoptions_multi") if n.startswith("month_key=")])
    read = [m for m in scans if m.get("partitions")]
    assert months > 70 and read and min(m["partitions"] for m in read) <= 6


def _scans(plan):
    """``numPartitions`` and ``numFiles`` of the file scans of an executed plan."""
    out, todo = [], [plan]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(p.plan())
            continue
        if name == "FileSourceScanExec":
            m = p.metrics()
            get = lambda k: m.apply(k).value() if m.contains(k) else None
            out.append({"partitions": get("numPartitions"), "files": get("numFiles")})
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


# ---------------------------------------------------------------- nested documents
DONORS = [{"donor_id": "D1", "focus_area": "Health", "priority_metrics": ["lives_saved", "x"], "preferred_counties": ["A", "A", "B"]},
          {"donor_id": "D2", "focus_area": "Gender", "priority_metrics": [], "preferred_counties": ["All"]},
          {"donor_id": "D3", "focus_area": "Gender", "priority_metrics": None, "preferred_counties": None},
          {"donor_id": "D4", "focus_area": "Gender", "priority_metrics": ["a_very_long_metric"], "preferred_counties": []}]


def test_json_arrays_round_trip(spark):
    s = Tables(spark, SF001)
    rows = files.donor_rows(s.supplier, s.nation)
    path = scratch_path(spark, "donor-arrays")
    files.write_json_arrays(rows, path, 3)
    assert len([n for n in storage.children(spark, path) if n.startswith("file=")]) > 1
    lines = [r.value for r in spark.read.option("recursiveFileLookup", True).text(path).collect()]
    assert all(isinstance(json.loads(v), list) for v in lines)
    back = files.read_donors(spark, path)
    key = lambda r: r.donor_id
    columns = schemas.struct(schemas.RAW_DONORS).fieldNames()
    assert sorted(back.select(columns).collect(), key=key) == sorted(rows.select(columns).collect(), key=key)


def test_preferences(spark):
    path = scratch_path(spark, "donors")
    spark.createDataFrame([(json.dumps(DONORS, indent=1),)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    counties = spark.createDataFrame([("A",), ("B",), ("C",)], "county string")
    got = files.donor_preferences(files.read_donors(spark, path), counties).collect()
    assert sorted((r.donor_id, r.county) for r in got) == [("D1", "A"), ("D1", "B"), ("D2", "A"), ("D2", "B"), ("D2", "C")]
    one = {r.donor_id: r for r in got}
    assert one["D1"].values_health and not one["D1"].takes_all and one["D2"].takes_all and not one["D2"].values_health
