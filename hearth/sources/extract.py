"""S11 between runs: a stored high-water mark, an overlap window, and each change delivered once.

A run delivers the rows whose version (the later of their created and modified times) lies
after a lower bound, then stores the highest version seen as the mark. The bound is the mark
less an overlap, so a row that reached the source late is still found; with a window such as
``LAST_N_DAYS:3`` it is the start of the day n days before the run, or the mark where that is
earlier, so a missed day loses nothing. What the bound lets through twice is taken out by an
anti join with the deliveries whose version lies after the same bound: only that window of
earlier deliveries is read, never all of them.

Run n writes ``run=n/rows`` and then the record ``run=n/mark.json``; the mark is the commit. A run that dies
before it leaves rows that no reader lists, and its retry has the same number and overwrites
them. A run that finds nothing new leaves the mark where it was.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import storage

VERSION = "version_ts"


def last_n_days(window: str, now: dt.datetime) -> dt.datetime:
    """The start of ``LAST_N_DAYS:n``: midnight, n days before the day of ``now``."""
    found = re.fullmatch(r"LAST_N_DAYS:(\d+)", window.strip(), re.IGNORECASE)
    if not found:
        raise ValueError(f"not a LAST_N_DAYS:n window: {window!r}")
    return dt.datetime.combine(now.date(), dt.time()) - dt.timedelta(days=int(found[1]))


def in_window(col: Column, window: str, now: dt.datetime) -> Column:
    """Rows of ``LAST_N_DAYS:n`` as the CRM's query language means it: from that midnight on."""
    return col >= F.lit(last_n_days(window, now)).cast("timestamp_ntz")


class Extract:
    """Incremental deliveries of one source, with their state under ``root``."""

    def __init__(self, spark: SparkSession, root: str, key: str, created: str = "created_ts", modified: str = "modified_ts",
                 overlap: dt.timedelta = dt.timedelta(hours=1), window: str | None = None):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.created, self.modified, self.overlap, self.window = created, modified, overlap, window

    def runs(self) -> list[int]:
        """Numbers of the committed runs."""
        found = [int(n[4:]) for n in storage.children(self.spark, self.root) if n.startswith("run=") and n[4:].isdigit()]
        return sorted(n for n in found if storage.get(self.spark, f"{self.root}/run={n}/mark.json") is not None)

    def mark(self) -> dt.datetime | None:
        """The highest version delivered so far."""
        runs = self.runs()
        held = storage.get(self.spark, f"{self.root}/run={runs[-1]}/mark.json")["mark"] if runs else None
        return None if held is None else dt.datetime.fromisoformat(held)

    def delivered(self) -> DataFrame | None:
        """Every delivered row with its run, version and run number; None before the first run."""
        runs = self.runs()
        if not runs:
            return None
        out = None
        for n in runs:
            part = self.spark.read.parquet(f"{self.root}/run={n}/rows").withColumn("run", F.lit(n))
            out = part if out is None else out.unionByName(part)
        return out

    def bound(self, now: dt.datetime | None) -> dt.datetime | None:
        """Versions after this can be new."""
        mark = self.mark()
        if mark is None:
            return None
        low = mark - self.overlap
        if self.window is not None:
            low = min(last_n_days(self.window, now) - dt.timedelta(microseconds=1), mark)
        return low

    def run(self, rows: DataFrame, now: dt.datetime | None = None) -> int:
        """Deliver what is new in ``rows`` (the source as it stands now); returns the run's number."""
        runs, low = self.runs(), self.bound(now)
        n = runs[-1] + 1 if runs else 0
        new = rows.withColumn(VERSION, F.greatest(self.created, self.modified))
        if low is not None:
            since = F.lit(low).cast("timestamp_ntz")
            # stated on the stored columns too, so that it reaches the scan where they are stored
            new = new.where((F.col(self.created) > since) | (F.col(self.modified) > since))
            seen = self.delivered().where(F.col(VERSION) > since).select(self.key, VERSION)
            new = new.join(seen, [self.key, VERSION], "left_anti")
        seen_high = Observation(f"extract-{n}")
        at = f"{self.root}/run={n}"
        (new.select(*rows.columns, VERSION).observe(seen_high, F.max(VERSION).alias("high"), F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").parquet(f"{at}/rows"))
        marks = [m for m in (seen_high.get["high"], self.mark()) if m is not None]
        storage.put(self.spark, f"{at}/mark.json", {"run": n, "rows": seen_high.get["rows"],
                                                    "mark": max(marks).isoformat() if marks else None})
        return n
