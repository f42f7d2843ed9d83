"""License scan by diagonal voting.

Every rolling word k-gram of every document is hashed and joined in Spark to the positions
of the license templates' k-grams. A match at document position p and template position t
votes for the diagonal p - t. Votes are aggregated per document, template and diagonal,
neighbouring diagonals (up to a fifth of the template's words inserted or dropped) are merged,
and each merged region, with the places of the template's missing head and tail, is verified
word by word against its template and for the words that tell its license from others.
Base phrases are found by exact place.

Defined results: a null or empty text has no words and no labels; a text shorter than a
k-gram has none; repeated rows give equal rows (documents meet their regions by id and text
hash); several templates of a label count once; null ids are kept; an empty table gives an
empty result; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise, pick

# Base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Notices of public licenses, and the label each stands for.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                 "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
              "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
)
# What the words of a notice, and three more, must hold; for each template. A place before the notice's end counts.
_NEXT = r"(?!(?:\S+ ){0,2}(?:non|noncommercial|sharealike|share|no ?deriv\w*) )"
DECIDING = tuple(re.compile(p.encode()) for p in (
    r" mit (?!0 |no attribution )",
    r"^(?!.* font )",
    r" apache (?:\S+ ){0,3}v?2 ",
    r" apache (?:\S+ ){0,4}2 ",
    r" by (?:nc|non ?commercial) (?!(?:sa|nd|share ?alike|no ?deriv\w*) )",
    r" attribution non ?commercial " + _NEXT,
    r" attribution " + _NEXT,
    r" gnu general public (?:\S+ ){0,4}?v(?:ersion )?3 | v(?:ersion )?3 of the gnu general public ",
    r" gnu general public .*v(?:ersion )?3 ",
    r" redistribution and use ",
    r"^(?!.* documentation )",
))
K = 3
BAND = 4               # diagonals this near are one region, or a fifth of a long template's words
LEAST_VOTES = 0.25     # of a template's k-grams
LEAST_SCORE = 0.8      # of a template's words found in order
AFTER = 3              # words behind a notice that can make it another license's
CACHE = 300_000
GRAMS = 1 << 20        # grams of one batch handed to the join

# A-Z to a-z; all but 0-9, a-z and bytes of non-ASCII characters to a space
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class Grams:
    """Rolling hashes of k words (polynomial in 64-bit word hashes)."""

    def __init__(self, k: int = K):
        self.k, self.known = k, {}

    def __call__(self, ws: list[bytes]) -> np.ndarray:
        import xxhash

        if len(ws) < self.k:
            return np.zeros(0, np.int64)
        known, digest = self.known, xxhash.xxh3_64_intdigest
        if len(known) > CACHE:
            known.clear()
        out = [known.get(w) for w in ws]
        if None in out:
            for i, h in enumerate(out):
                if h is None:
                    w = ws[i]
                    h = known.get(w)
                    if h is None:
                        h = digest(w)
                        if len(w) <= 64:
                            known[w] = h
                    out[i] = h
        h = np.array(out, np.uint64)
        n = len(h) - self.k + 1
        g = np.zeros(n, np.uint64)
        for j in range(self.k):
            g = g * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n]
        return g.view(np.int64)


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """``(template, gram, tpos, size)``: a row per k-gram of every template (fixed size)."""
    grams = Grams(k)
    rows = []
    for i, (_, text) in enumerate(templates):
        g = grams(words(text.encode()))
        rows += [(i, int(x), p, len(g)) for p, x in enumerate(g)]
    return spark.createDataFrame(rows, "template int, gram bigint, tpos int, size int")


def regions(docs: DataFrame, templates=TEMPLATES, k: int = K, band: int = BAND,
            least_votes: float = LEAST_VOTES) -> DataFrame:
    """``(doc_id, text_hash, template, first, last)``: merged diagonals with enough votes, per row.

    ``first`` and ``last`` are where the template's words would begin and end on the diagonals.
    Votes are counted per row of ``docs``, so copies neither add up nor meet in one group.
    """
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        grams, row = Grams(k), TaskContext.get().partitionId() << 33
        for b in batches:
            made, n = [], 0
            for i, t in enumerate(b.column(2)):
                g = grams(words(t.as_py() or b""))
                # a very long text is handed on in parts; its grams are all there
                for s in range(0, max(1, len(g)), GRAMS):
                    made.append((i, s, g[s:s + GRAMS]))
                    n += len(made[-1][2])
                if n >= GRAMS or i == b.num_rows - 1:
                    rows = pa.array([m[0] for m in made], pa.int32())
                    offsets = pa.array(np.cumsum([0] + [len(m[2]) for m in made]), pa.int32())
                    flat = pa.array(np.concatenate([m[2] for m in made]), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row + m[0] for m in made], pa.int64()), b.column(0).take(rows), b.column(1).take(rows),
                         pa.array([m[1] for m in made], pa.int32()), pa.ListArray.from_arrays(offsets, flat)],
                        names=["row", "doc_id", "text_hash", "begin", "grams"])
                    made, n = [], 0
            row += b.num_rows

    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"),
                       F.col("text").cast("binary").alias("text"))
    grams = rows.mapInArrow(run, "row bigint, doc_id bigint, text_hash bigint, begin int, grams array<bigint>").select(
        "row", "doc_id", "text_hash", "begin", F.posexplode("grams").alias("i", "gram"))
    table = F.broadcast(template_grams(docs.sparkSession, templates, k))  # a few hundred rows, fixed
    p = F.col("begin") + F.col("i")
    doc = ["row", "doc_id", "text_hash", "template"]
    votes = (grams.join(table, "gram").groupBy(*doc, "size", (p - F.col("tpos")).alias("diagonal"))
             .agg(F.count(F.lit(1)).alias("votes"), F.min(p).alias("first"), F.max(p + F.lit(k)).alias("last")))
    order = Window.partitionBy(*doc).orderBy("diagonal")
    length = F.col("size") + F.lit(k - 1)  # words of the template
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > F.greatest(F.lit(band), F.floor(length / 5))
    merged = (votes.withColumn("region", F.count_if(apart).over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*doc, "size", "region").agg(F.sum("votes").alias("votes"),
                                                   F.min(F.least("first", "diagonal")).alias("first"),
                                                   F.max(F.greatest("last", F.col("diagonal") + length)).alias("last")))
    return merged.where(F.col("votes") >= F.greatest(F.lit(1), F.col("size") * F.lit(least_votes))).select(
        *doc[1:], "first", "last")


def verify(ws: list[bytes], template: list[bytes], first: int, last: int, slack: int) -> list[tuple[int, int, float]]:
    """(start, end, share of the template's words found in order) around a region.

    Repeats of a notice can merge into one long region: it is read in windows of twice the
    template, half a window apart, so each repeat lies whole in one of them and words
    scattered over more than a window never add up.
    """
    begin, end = max(0, first - slack), last + slack
    step = len(template) + slack
    out = []
    for at in range(begin, max(begin + 1, end - step), step):
        blocks = [m for m in SequenceMatcher(None, ws[at:min(end, at + 2 * step)], template, autojunk=False)
                  .get_matching_blocks() if m.size]
        if blocks:
            out.append((at + blocks[0].a, at + blocks[-1].a + blocks[-1].size, sum(m.size for m in blocks) / len(template)))
    return out


def decided(ws: list[bytes], start: int, end: int, deciding: re.Pattern | None) -> bool:
    """Whether the words that tell the license from others stand in the notice."""
    if deciding is None:
        return True
    notice = b" " + b" ".join(ws[start:end]) + b" "
    found = deciding.search(b" " + b" ".join(ws[start:end + AFTER]) + b" ")
    return found is not None and found.start() < len(notice) - 1


def base_places(ws: list[bytes], base=BASE) -> list[tuple[int, str]]:
    """Every place (word index) where a phrase's words stand consecutively."""
    joined = b" " + b" ".join(ws) + b" "
    out = []
    for phrase, label in base:
        needle = b" " + phrase.encode() + b" "
        at, seen, word = joined.find(needle), 0, 0
        while at >= 0:
            word += joined.count(b" ", seen, at)  # words before the place, counted on from the last one
            seen = at
            out.append((word, label))
            at = joined.find(needle, at + 1)
    return sorted(out)


SPANS = "array<struct<label:string,start:bigint,end:bigint,score:double>>"


def scan(docs: DataFrame, templates=TEMPLATES, k: int = K, band: int = BAND, least_votes: float = LEAST_VOTES,
         least_score: float = LEAST_SCORE, deciding: tuple | None = None) -> DataFrame:
    """A row per document: word and base counts, labels, the verified spans and the best score.

    ``deciding`` has a pattern or None for each template; those of ``TEMPLATES`` are the default for them.
    """
    if deciding is None:
        deciding = DECIDING if templates is TEMPLATES else (None,) * len(templates)
    docs = pick(docs, "doc_id", "text")
    found = materialise(regions(docs, templates, k, band, least_votes)
                        .groupBy(F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash"))
                        .agg(F.collect_set(F.struct("template", "first", "last")).alias("regions")), "license-regions")
    rows = (docs.select(F.col("doc_id").cast("bigint"), F.col("text"))
            .join(broadcast_if_small(found, 160), F.col("doc_id").eqNullSafe(F.col("r_id"))
                  & (F.xxhash64("text") == F.col("r_hash")), "left")
            .select("doc_id", F.col("text").cast("binary").alias("text"), "regions"))
    texts = [words(t.encode()) for _, t in templates]

    def run(batches):
        import pyarrow as pa
        kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("score", pa.float64())]))
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for text, region in zip(b.column(1), b.column(2)):
                ws = words(text.as_py() or b"")
                places = base_places(ws)
                best: dict = {}
                for r in region.as_py() or []:
                    template = texts[r["template"]]
                    slack = max(band, len(template) // 5)
                    for start, end, score in verify(ws, template, r["first"], r["last"], slack):
                        span = (templates[r["template"]][0], start, end)
                        if score >= least_score and decided(ws, start, end, deciding[r["template"]]):
                            best[span] = max(score, best.get(span, 0.0))
                spans = [{"label": s[0], "start": s[1], "end": s[2], "score": best[s]}
                         for s in sorted(best, key=lambda s: (s[1], s[2], s[0]))]
                base = sorted({label for _, label in places})
                row = (len(ws), len(places), places[0][0] if places else None, places[-1][0] if places else None,
                       ",".join(base), ",".join(sorted({*base, *(s[0] for s in best)})),
                       1.0 if places else max(best.values(), default=0.0), spans)
                for c, v in zip(cols, row):
                    c.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), kind]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                                f"base_labels string, labels string, score double, spans {SPANS}")
