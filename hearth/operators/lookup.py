"""Natural-key lookup where one key may hold much of the fact.

A shuffle join puts all rows of a key into one task. The keys that hold more than a share of
the rows are found with a bounded-memory frequency sketch (at most ``TRACKED`` counters a task,
so every key above 1 / ``TRACKED`` of the rows is seen); there can only be few of them. Their
rows meet the few dimension rows of those keys by broadcast, where they lie; all other rows
are joined as usual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACKED = 4096      # counters of the sketch
MOST_HOT = 64       # keys that can be treated as hot; a share above 1 / MOST_HOT has at most so many
HOT_SHARE = 1 / 64


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold more than ``share`` of the rows (at most ``1 / share``), not counting NULL."""
    known = rows.where(F.col(key).isNotNull())
    top, n = known.agg(F.expr(f"approx_top_k(`{key}`, {MOST_HOT}, {TRACKED})"), F.count(F.lit(1))).first()
    return [r.item for r in top or [] if r["count"] > share * n]


def lookup(rows: DataFrame, dim: DataFrame, key: str, how: str = "left", hot: list | None = None) -> DataFrame:
    """``rows`` joined with ``dim`` (one row per ``key``) on ``key``; ``how`` is ``left`` or ``inner``."""
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    hot = hot_keys(rows, key) if hot is None else hot
    if not hot:
        return rows.join(dim, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    few = F.broadcast(dim.where(F.col(key).isin(hot)))      # at most MOST_HOT rows: one per key
    return (rows.where(is_hot).join(few, key, how)
            .unionByName(rows.where(~is_hot).join(dim.where(~F.col(key).isin(hot)), key, how)))
