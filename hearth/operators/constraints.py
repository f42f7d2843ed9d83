"""The schema's constraints on load. Rows are split into accepted and rejected, with the reasons.

The meaning is SQL's: a CHECK, a foreign key and a UNIQUE hold where they cannot be decided (a
NULL), NOT NULL does not. Every broken NOT NULL, CHECK, length and foreign key of a row is
listed. Uniqueness is judged among rows that break none of these, since only they would be
stored: the first row by ``order`` is accepted, later ones are rejected. Rows equal in every
column count as many: one is accepted.

All single-row rules are one projection. A foreign key is a left join with the distinct
referenced keys, which cannot multiply rows. For a UNIQUE only keys that occur twice are looked
at again: their first row comes from a combining minimum, so a key with a third of all rows is
reduced in every map task, and equal rows are counted, not sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASONS = "reasons"


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def reason(self) -> str:
        return f"not_null:{self.column}"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class MaxLength:
    column: str
    length: int

    @property
    def reason(self) -> str:
        return f"length:{self.column}"

    def broken(self) -> Column:
        return F.length(self.column) > self.length


@dataclass(frozen=True)
class Check:
    name: str
    holds: Column

    @property
    def reason(self) -> str:
        return f"check:{self.name}"

    def broken(self) -> Column:
        return ~self.holds


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: DataFrame
    key: str

    @property
    def reason(self) -> str:
        return f"foreign_key:{self.column}"


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]

    @property
    def reason(self) -> str:
        return f"unique:{','.join(self.columns)}"


def of_schema(schema: T.StructType, required: Sequence[str] = (), lengths: dict[str, int] | None = None) -> list:
    """NOT NULL and length rules of a table's columns."""
    names = set(schema.fieldNames())
    return ([NotNull(c) for c in required if c in names]
            + [MaxLength(c, n) for c, n in (lengths or {}).items() if c in names])


def judge(rows: DataFrame, constraints: Sequence, order: Sequence[str]) -> DataFrame:
    """``rows`` and ``reasons`` array<string>: empty where the row is accepted, else in the constraints' order."""
    found: dict[str, Column] = {}
    j = rows
    for i, c in enumerate(constraints):
        if isinstance(c, ForeignKey):
            hit = f"_known{i}"
            keys = (c.table.select(F.col(c.key).cast(rows.schema[c.column].dataType).alias(f"_key{i}")).where(F.col(f"_key{i}").isNotNull())
                    .distinct().withColumn(hit, F.lit(True)))
            j = j.join(keys, F.col(c.column) == F.col(f"_key{i}"), "left").drop(f"_key{i}")
            found[c.reason] = F.col(c.column).isNotNull() & F.col(hit).isNull()
        elif not isinstance(c, Unique):
            found[c.reason] = F.coalesce(c.broken(), F.lit(False))
    named = [F.when(broken, F.lit(reason)) for reason, broken in found.items()]
    reasons = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    out = j.select(*rows.columns, reasons.alias(REASONS))
    for c in constraints:
        if isinstance(c, Unique):
            out = _unique(out, c, order)
    return out


def _unique(rows: DataFrame, rule: Unique, order: Sequence[str]) -> DataFrame:
    keys = list(rule.columns)
    clean = F.size(REASONS) == 0
    whole = clean
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    place = F.struct(*[F.col(c) for c in order])
    first = (rows.where(whole).groupBy(*keys).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") > 1).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_first"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    j = rows.join(first, same & clean, "left").drop(*[f"_k_{k}" for k in keys])
    again = F.array(F.lit(rule.reason))
    alone = (j.where(F.col("_first").isNull() | (place != F.col("_first")))
             .withColumn(REASONS, F.when(F.col("_first").isNotNull(), again).otherwise(F.col(REASONS))).drop("_first"))
    # the first row of a repeated key, and rows that tie with it: equal ones are counted
    ties = (j.where(place == F.col("_first")).drop("_first").groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_at", F.struct(*[c for c in rows.columns if c != REASONS])))
    least = ties.groupBy(*keys).agg(F.min("_at").alias("_least")).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_least")
    ties = (ties.join(least, same).drop(*[f"_k_{k}" for k in keys])
            .select(*rows.columns, (F.col("_at") == F.col("_least")).alias("_wins"), F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_i"))
            .withColumn(REASONS, F.when(F.col("_wins") & (F.col("_i") == 1), F.col(REASONS)).otherwise(again)).select(*rows.columns))
    return alone.unionByName(ties)


def split(rows: DataFrame, constraints: Sequence, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``; rejected rows carry ``reasons``. Write ``judge``'s result once where both are needed."""
    judged = judge(rows, constraints, order)
    return judged.where(F.size(REASONS) == 0).drop(REASONS), judged.where(F.size(REASONS) > 0)
