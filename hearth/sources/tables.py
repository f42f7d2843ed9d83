"""S3: pruned parquet scans of the driver tables, with their declared schemas."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")

# The tables that the programme's star is derived from. A declared schema needs no job that
# reads file footers before the query is planned.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A lazy parquet scan; Catalyst prunes columns and pushes filters into it.

    Files are listed afresh each time, so a result depends on what is there now and not on
    what the session saw before. Tables without a declared schema take it from their files.
    """
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazily opened driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            df = read_table(self.spark, self.sf_dir, name)
            setattr(self, name, df)
            return df
        raise AttributeError(name)

    def derived(self, key, make):
        """A lazy DataFrame derived from these tables, built once per ``key``."""
        memo = self.__dict__.setdefault("_derived", {})
        if key not in memo:
            memo[key] = make()
        return memo[key]

    @cached_property
    def star(self):
        from .adapters import StarSchema
        return StarSchema(self)
