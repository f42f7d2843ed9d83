"""Mixing sources to target weights along a time-varying curriculum.

Each source takes a target number of words: its weight's share of 150% of all words,
stopped at twice its own words, the excess shared again by weight. Within a source the
documents stand in a fixed pseudo-random order; their words are laid end to end, once per
pass, until the target is met (the last document may be cut). A source's weight schedule
(piecewise linear in training time 0..1) is integrated; the share of the target already
used, looked up in the inverse of that integral, is the time at which a document trains.
The stream is then range-sorted by that time.

Defined results: a null text has size 0 and is never taken; a null source is a source of its
own, after all others; null ids sort first among equals; repeated rows are separate rows,
each with its own place; an empty table gives an empty result; columns other than those
named are carried through unread.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise

WEIGHTS = (5, 2, 1)
# (time, relative rate) knots per position of the weight cycle: steady, rising, falling.
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
             ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)))
SHARE = 1.5
CAP = 2
WORD = r"[^\x20\x09-\x0D]+"
PER_BUCKET = 10_000    # rows of one source ordered in one window group


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, verbatim."""
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Adds ``cycle`` and ``target`` to ``(source, source_size)``, one row per source.

    Capping at ``cap`` sizes and sharing the excess by weight until none is above it is
    a water level: sources are capped in the order of cap / weight while the level that
    is left for the rest stands above that ratio. Windows over one row per source.
    """
    every = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("cycle") + 1).cast("int"))
    t = (sources.withColumn("cycle", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
                            % len(weights))
         .withColumn("_w", weight).withColumn("_cap", (F.col("source_size") * cap).cast("double")))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(every).cast("double") * F.lit(share)
    spent = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("_level", (total - spent) / rest)
    free = F.col("_level") < F.col("_cap") / F.col("_w")
    level = F.max(F.when(free, F.col("_level"))).over(every)
    return (t.withColumn("target", F.when(free, F.least("_cap", level * F.col("_w"))).otherwise(F.col("_cap")))
            .drop("_w", "_cap", "_level"))


def time_of(share: Column, knots) -> Column:
    """Training time at which a schedule has used ``share`` (0..1) of its integral."""
    times, rates = zip(*knots)
    if any(r <= 0 for r in rates) or list(times) != sorted(set(times)):
        raise ValueError("a schedule needs positive rates at increasing times")
    area = [0.0]
    for j in range(len(knots) - 1):
        area.append(area[-1] + (times[j + 1] - times[j]) * (rates[j] + rates[j + 1]) / 2)
    used, out = share * F.lit(area[-1]), None
    for j in reversed(range(len(knots) - 1)):
        y = F.greatest(used - F.lit(area[j]), F.lit(0.0))
        slope = (rates[j + 1] - rates[j]) / (times[j + 1] - times[j])
        root = F.sqrt(F.greatest(F.lit(rates[j] ** 2) + F.lit(2 * slope) * y, F.lit(0.0)))
        here = F.lit(times[j]) + F.lit(2.0) * y / (F.lit(rates[j]) + root)
        out = here if out is None else F.when(used < F.lit(area[j + 1]), here).otherwise(out)
    return out


def plan(docs: DataFrame, keep: list[str], weights=WEIGHTS, schedules=SCHEDULES, share: float = SHARE,
         cap: int = CAP, per_bucket: int = PER_BUCKET) -> DataFrame:
    """One row per document: ``row`` (a struct of the ``keep`` columns), size, source_size, target, taken, passes, part, position, copies.

    ``passes`` whole copies and ``part`` words of one more are taken; ``copies`` holds a
    struct (pass, words, position) of each, ``position`` is the first one's.

    The running word count of a source is cut into buckets of the order key: bucket
    sums (one narrow pass with map-side combine) give each bucket's offset, and windows
    run per (source, bucket), so a source with a third of all rows spreads over many tasks.
    """
    buckets = 1 << min(20, max(6, math.ceil(math.log2(max(1, docs.count() / per_bucket)))))
    # by id and text, so that the rows of one repeated id spread as those of many ids do
    key = F.md5(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit(":"),
                         F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary"))).cast("binary"))
    rows = docs.select(
        F.struct(*[docs[c] for c in keep]).alias("row"),
        F.coalesce(F.concat(F.lit("s"), docs["source"]), F.lit("n")).alias("_source"),
        key.alias("_order"), docs["doc_id"].alias("_id"), word_count(docs["text"]).alias("_size"),
        F.floor(F.conv(F.substring(key, 1, 5), 16, 10).cast("bigint") * buckets / (1 << 20)).cast("int").alias("_bucket"))
    if not set(keep) & {"text"}:
        rows = materialise(rows, "mixing-rows")  # narrow: texts are read once
    sums = materialise(rows.groupBy("_source", "_bucket").agg(F.sum("_size").alias("words")), "mixing-sums")
    sources = targets(sums.groupBy("_source").agg(F.sum("words").alias("source_size"))
                      .select("_source", "source_size",
                              F.when(F.col("_source") != "n", F.substring("_source", 2, 1 << 30)).alias("source")),
                      weights, share, cap)
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(sums.withColumn("_before", F.coalesce(F.sum("words").over(before), F.lit(0)))
                          .join(sources, "_source")
                          .select("_source", "_bucket", "_before", "source_size", "target", "cycle"), "mixing-offsets")
    inside = (Window.partitionBy("_source", "_bucket").orderBy("_order", "_id", "_size")
              .rowsBetween(Window.unboundedPreceding, -1))
    at = (rows.join(broadcast_if_small(offsets, 64), ["_source", "_bucket"])
          .withColumn("_start", F.col("_before") + F.coalesce(F.sum("_size").over(inside), F.lit(0))))
    quota = F.floor("target").cast("bigint")
    some = F.col("source_size") > 0
    passes = F.when(some, F.expr("cast(floor(target) as bigint) div greatest(source_size, 1)")).otherwise(F.lit(0))
    out = (at.withColumn("passes", F.when(F.col("_size") > 0, passes).otherwise(F.lit(0)).cast("bigint"))
           .withColumn("part", F.least(F.greatest(quota - passes * F.col("source_size") - F.col("_start"), F.lit(0)),
                                       F.col("_size")).cast("bigint"))
           .withColumn("taken", F.col("passes") * F.col("_size") + F.col("part")))

    def position(n: Column) -> Column:
        used = (n * F.col("source_size") + F.col("_start")) / F.greatest(F.col("target"), F.lit(1.0))
        pos = None
        for i, knots in enumerate(schedules):
            here = time_of(F.least(used, F.lit(1.0)), knots)
            pos = here if pos is None else F.when(F.col("cycle") % len(schedules) == i, here).otherwise(pos)
        return pos

    n = F.col("passes") + F.when(F.col("part") > 0, 1).otherwise(0)
    copies = F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), F.greatest(n, F.lit(1)) - 1), lambda i: F.struct(
        i.alias("pass"), F.when(i < F.col("passes"), F.col("_size")).otherwise(F.col("part")).alias("words"),
        position(i).alias("position")))).otherwise(F.array())
    return out.select("row", F.col("_size").alias("size"), "source_size", "target", "taken", "passes", "part",
                      F.when(n > 0, position(F.lit(0))).alias("position"), copies.alias("copies"), "_order")


def training_order(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents in training order: the columns of ``docs``, a row per copy taken.

    A cut copy carries the words it takes; ``n_chars`` follows the text. One shuffle lays
    out the words, one range partitioning sorts the copies by position.
    """
    columns = docs.columns
    mixed = plan(docs, columns, **options).where("taken > 0")
    rows = mixed.select("row", "size", "_order", F.explode("copies").alias("copy"))
    text = F.col("row.text")
    rows = rows.withColumn("text", F.when(F.col("copy.words") < F.col("size"),
                                          first_words(text, F.col("copy.words"))).otherwise(text))
    new = {"text": F.col("text")}
    if "n_chars" in columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return (rows.orderBy("copy.position", "_order", "copy.pass")
            .select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in columns]))
