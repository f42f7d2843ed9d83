"""Q13 / Q10: run metrics that decide whether an output is published.

The output is written beside the table while one ``Observation`` counts its rows, the NULLs of
its required columns and the rows that fail its rules, so judging costs no further pass. Only
if every threshold holds is it put in the table's place; else the old table stays. Either way
an audit row says what was measured and why.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import storage

AUDIT = ("output string, batch string, published boolean, rows bigint, expected bigint, nulls bigint, failures bigint, "
         "duration_sec double, breaches array<string>")


# The documented alert thresholds.
@dataclass(frozen=True)
class Thresholds:
    most_seconds: float = 30 * 60
    least_records: float = 0.90       # of those expected
    most_failures: float = 0.05       # of the rows
    most_nulls: float = 0.02          # of the required values


@dataclass(frozen=True)
class Rules:
    """What an output must hold: required columns, and rules that are true for a good row."""
    required: Sequence[str] = ()
    valid: dict[str, Column] = field(default_factory=dict)


def judge(rows: int, expected: int | None, nulls: int, failures: int, seconds: float, required: int,
          t: Thresholds = Thresholds()) -> list[str]:
    """Names of the thresholds that are broken."""
    out = []
    if seconds > t.most_seconds:
        out.append("duration")
    if expected is not None and rows < t.least_records * expected:
        out.append("records")
    if rows and failures > t.most_failures * rows:
        out.append("failures")
    if rows * required and nulls > t.most_nulls * rows * required:
        out.append("nulls")
    return out


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """The published table: that of the newest published batch."""
    records = [storage.get(spark, f"{root}/published/{n}") for n in storage.children(spark, f"{root}/published") if n.endswith(".json")]
    if not records:
        return None
    newest = max(records, key=lambda r: (r["at"], r["batch"]))
    return spark.read.parquet(f"{root}/written/{newest['batch']}")


def publish(df: DataFrame, root: str, batch: str, rules: Rules, expected: int | None = None,
            thresholds: Thresholds = Thresholds(), at: dt.datetime | None = None) -> list[str]:
    """Write ``df`` as ``batch`` and publish it unless a threshold is broken; returns what was broken."""
    spark, root = df.sparkSession, root.rstrip("/")
    began = dt.datetime.now(dt.timezone.utc)
    nulls = [F.count_if(F.col(c).isNull()) for c in rules.required]
    bad = F.lit(False)
    for rule in rules.valid.values():
        bad = bad | ~F.coalesce(rule, F.lit(False))
    seen = Observation(f"gate-{batch}")
    total = nulls[0] if nulls else F.count_if(F.lit(False))
    for n in nulls[1:]:
        total = total + n
    (df.observe(seen, F.count(F.lit(1)).alias("rows"), total.alias("nulls"), F.count_if(bad).alias("failures"))
     .write.mode("overwrite").parquet(f"{root}/written/{batch}"))
    m = seen.get
    seconds = (dt.datetime.now(dt.timezone.utc) - began).total_seconds()
    broken = judge(m["rows"], expected, m["nulls"], m["failures"], seconds, len(rules.required), thresholds)
    when = (at or dt.datetime.now(dt.timezone.utc)).replace(tzinfo=None)
    if not broken:
        storage.put(spark, f"{root}/published/{batch}.json", {"batch": batch, "at": when.isoformat()})
    storage.put(spark, f"{root}/audit/{batch}.json", {
        "output": root.rsplit("/", 1)[-1], "batch": batch, "published": not broken, "rows": m["rows"], "expected": expected,
        "nulls": m["nulls"], "failures": m["failures"], "duration_sec": seconds, "breaches": broken})
    return broken


def audit(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch judged."""
    return spark.read.schema(AUDIT).json(f"{root}/audit")
