"""The full bronze -> silver -> gold run as a graph of outputs, with commits, resuming and a run audit (Q13).

Every output names the driver tables and the other outputs it is made from. Its fingerprint is a
hash of the version of the rules, the listings of its tables' files (name, size, time) and the
fingerprints of its inputs. An output is written to ``<name>/<fingerprint>`` and then committed by
a small record ``_commits/<name>/<fingerprint>.json``, so

* a run that was killed leaves commits of what it finished; the next run makes only the rest,
* a run over unchanged tables makes nothing,
* a changed table remakes what depends on it and nothing else,
* a half-written output has no commit and is overwritten.

Outputs whose inputs are ready run at the same time, so small ones fill the cluster together.
Later outputs read the committed files of earlier ones, which also cuts the lineage.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, quality, silver
from ..session import scratch_path
from ..sources import storage
from ..sources.tables import Tables

RULES = "3"          # changed when an output's definition changes
AT_ONCE = 4          # outputs made at the same time


@dataclass(frozen=True)
class Output:
    """One written table: the driver tables and outputs it needs, and how it is made of them."""
    tables: tuple[str, ...]
    needs: tuple[str, ...]
    make: Callable


GEO, HOMES = ("nation", "region"), ("customer", "nation")
OUTPUTS: dict[str, Output] = {
    "fact_adoptions": Output(("orders", "customer", "part"), (), lambda s, r: s.fact_adoptions),
    "household_checks": Output(HOMES, (), lambda s, r: quality.quality_checks(s.dim_household)),
    "silver_households": Output(HOMES, (), lambda s, r: silver.silver_households(s.dim_household)),
    "silver_adoption_metrics": Output((*HOMES, "region"), ("fact_adoptions",), lambda s, r: silver.silver_adoption_metrics(
        r("fact_adoptions"), s.dim_household, s.dim_geography)),
    "silver_impact_calculations": Output((*GEO, "part"), ("fact_adoptions",), lambda s, r: silver.silver_impact_calculations(
        r("fact_adoptions"), s.dim_product, s.dim_geography)),
    "gold_executive_summary": Output((), ("fact_adoptions", "silver_impact_calculations"), lambda s, r: gold.gold_executive_summary(
        r("fact_adoptions"), r("silver_impact_calculations"))),
    "gold_county_performance": Output((*GEO, "part"), ("fact_adoptions", "silver_impact_calculations"),
                                      lambda s, r: gold.gold_county_performance(
        r("fact_adoptions"), s.dim_geography, s.dim_product, r("silver_impact_calculations"))),
    "gold_donor_health_impact": Output((*HOMES, "region"), ("fact_adoptions", "silver_impact_calculations"),
                                       lambda s, r: gold.gold_donor_health_impact(
        r("fact_adoptions"), s.dim_household, s.dim_geography, r("silver_impact_calculations"))),
    "gold_donor_environment_impact": Output((*GEO, "part"), ("fact_adoptions", "silver_impact_calculations"),
                                            lambda s, r: gold.gold_donor_environment_impact(
        r("fact_adoptions"), s.dim_product, s.dim_geography, r("silver_impact_calculations"))),
    "gold_donor_gender_impact": Output((*HOMES, "region"), ("fact_adoptions", "silver_impact_calculations"),
                                       lambda s, r: gold.gold_donor_gender_impact(
        r("fact_adoptions"), s.dim_household, s.dim_geography, r("silver_impact_calculations"))),
    "gold_checks": Output((), ("gold_executive_summary", "gold_county_performance"), lambda s, r: quality.gold_checks(
        r("gold_executive_summary"), r("gold_county_performance"))),
}


class Graph:
    """The committed outputs of one folder, made from one set of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, out: str, outputs: dict[str, Output] | None = None):
        self.spark, self.sf_dir, self.out = spark, sf_dir.rstrip("/"), out.rstrip("/")
        self.outputs = OUTPUTS if outputs is None else outputs
        self.star = Tables(spark, sf_dir).star
        self._listed: dict[str, str] = {}
        self._prints: dict[str, str] = {}

    def _listing(self, table: str) -> str:
        if table not in self._listed:
            self._listed[table] = repr(storage.listing(self.spark, f"{self.sf_dir}/{table}.parquet"))
        return self._listed[table]

    def fingerprint(self, name: str) -> str:
        if name not in self._prints:
            o = self.outputs[name]
            parts = [RULES, name, *[f"{t}:{self._listing(t)}" for t in o.tables], *[f"{n}:{self.fingerprint(n)}" for n in o.needs]]
            self._prints[name] = hashlib.sha256("\n".join(parts).encode()).hexdigest()[:20]
        return self._prints[name]

    def _path(self, name: str) -> str:
        return f"{self.out}/{name}/{self.fingerprint(name)}"

    def _commit_path(self, name: str) -> str:
        return f"{self.out}/_commits/{name}/{self.fingerprint(name)}.json"

    def committed(self, name: str) -> bool:
        return storage.get(self.spark, self._commit_path(name)) is not None and storage.complete(self.spark, self._path(name))

    def read(self, name: str) -> DataFrame:
        """A committed output."""
        return self.spark.read.parquet(self._path(name))

    def rows(self, name: str) -> int:
        return storage.get(self.spark, self._commit_path(name))["rows"]

    def make(self, name: str) -> int:
        """Write and commit one output; its inputs must be committed."""
        seen = Observation(f"{name}-{self.fingerprint(name)}")
        df = self.outputs[name].make(self.star, self.read)
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(self._path(name))
        rows = int(seen.get["rows"])
        storage.put(self.spark, self._commit_path(name), {"output": name, "fingerprint": self.fingerprint(name), "rows": rows})
        return rows

    def run(self, at_once: int = AT_ONCE) -> tuple[list[str], list[str]]:
        """Make what is not committed, inputs first; returns the names made and those found.

        A failing output stops new ones from starting; those running are waited for, so their
        commits stand, and the error is raised.
        """
        found = [n for n in self.outputs if self.committed(n)]
        ready, made = set(found), []
        waiting = {n: set(o.needs) - ready for n, o in self.outputs.items() if n not in ready}
        running: dict = {}
        with ThreadPoolExecutor(at_once) as pool:
            failed = None
            while running or (waiting and failed is None):
                if failed is None:
                    for n in [n for n, left in waiting.items() if not left]:
                        del waiting[n]
                        running[pool.submit(inheritable_thread_target(self.spark)(self.make), n)] = n
                done, _ = wait(running, return_when=FIRST_COMPLETED)
                for f in done:
                    n = running.pop(f)
                    if f.exception() is not None:
                        failed = failed or f.exception()
                        continue
                    made.append(n)
                    for left in waiting.values():
                        left.discard(n)
            if failed is not None:
                raise failed
        return made, found


def run(spark: SparkSession, sf_dir: str, out_dir: str | None = None) -> dict:
    """Run or resume every output; returns success, duration, row counts, checks, and what was made."""
    out = out_dir or scratch_path(spark, "refresh")
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    t0 = time.perf_counter()
    graph = Graph(spark, sf_dir, out)
    rows: dict[str, int] = {}
    checks: dict[str, int] = {}
    made: list[str] = []
    ok = False
    try:
        made, _ = graph.run()
        rows = {n: graph.rows(n) for n in OUTPUTS if not n.endswith("_checks")}
        checks = {f"household_{k}": int(v) for k, v in graph.read("household_checks").first().asDict().items()}
        g = graph.read("gold_checks").first()
        checks["gold_totals_match"] = int(bool(g.totals_match))
        checks["gold_counties_over_100pct"] = int(g.counties_over_100pct)
        checks["gold_counties_nonpositive_roi"] = int(g.counties_nonpositive_roi)
        ok = True
    finally:
        duration = time.perf_counter() - t0
        if not ok:   # what was committed before the failure
            rows = {n: graph.rows(n) for n in OUTPUTS if graph.committed(n)}
        audit = spark.createDataFrame(
            [(started, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), duration, ok, rows, checks, sorted(made))],
            "started_at timestamp_ntz, ended_at timestamp_ntz, duration_sec double, success boolean, "
            "rows map<string,bigint>, checks map<string,bigint>, made array<string>")
        audit.coalesce(1).write.mode("append").parquet(f"{out}/run_audit")
    return {"success": ok, "duration_sec": duration, "rows": rows, "checks": checks, "output": out, "made": made}
