"""Secret scan with corpus-wide ownership frequency.

Three base patterns (assignments, access keys, long hex strings) and one wide candidate
pattern (bare mixed strings of high entropy) are found in every whole text. The hashes of all
candidate values are counted over the corpus by distinct owners, by distinct repositories, and
by text classes: equal texts, and texts that are near copies but for the values, are one class.
The counts give a value its verdict:

* ``example``: calls itself an example and several owners hold it, or looks plain and
  ``example_owners`` owners hold it in several classes;
* ``owner_live``: one owner holds it and it looks random; ``owner_plain``: it does not;
* ``marked``: one owner holds it and it calls itself an example;
* ``copied_with_text``: several owners hold it, all in copies of one text;
* ``leaked``: several owners hold it in texts of their own, and it looks random;
* ``shared``: the same, but it looks plain and fewer than ``example_owners`` hold it.

Base spans and wide candidates (kind ``bare``) are all reported, with their verdicts and
counts. Redaction masks every value but examples.

Defined results: a null or empty text has no span; null owners and repositories count as
one unknown owner and repository; repeated rows are separate rows (they do not raise any of
the counts); a text of any length is scanned whole; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, components, fresh, materialise

# The base patterns and the least length of what each must hold.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more; shorter runs hold none
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "bare")

BARE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MIN_ENTROPY = 3.0      # bits per character of a live-looking value
EXAMPLE_OWNERS = 3     # a plain value held by this many owners in texts of their own is an example
MARK = re.compile("example", re.IGNORECASE | re.ASCII)  # a value that calls itself an example
BANDS, BAND = 10, 3    # texts that share a band of minima of their word pairs are near copies

_MAYBE = r"(?i)password|passwd|secret|token|api_?key|AKIA|[0-9a-z+/_=-]{20}"
_FOUND = "array<struct<start:int,kind:int,end:int,from:int,value:string,live:boolean,marked:boolean>>"


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def candidates(text: str) -> list[dict]:
    """Base spans and wide candidates of one text; ``from`` is where the value begins."""
    found = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= ASSIGN_LEAST:
            found.append((m.start(), 0, m.end(), m.start(2)))
    for m in ACCESS.finditer(text):
        if len(m[0]) >= ACCESS_LEAST:
            found.append((m.start(), 1, m.end(), m.start()))
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    base = sorted(found)
    for m in BARE.finditer(text):
        s = m[0]
        if (any(c.isdigit() for c in s) and any(c.isalpha() for c in s) and entropy(s) >= MIN_ENTROPY
                and not any(b[0] < m.end() and m.start() < b[2] for b in base)):
            found.append((m.start(), 3, m.end(), m.start()))
    out = []
    for start, kind, end, begin in sorted(found):
        value = text[begin:end]
        out.append({"start": start, "kind": kind, "end": end, "from": begin,
                    "value": hashlib.sha256(value.encode()).hexdigest(), "live": entropy(value) >= MIN_ENTROPY,
                    "marked": MARK.search(value) is not None})
    return out


_FACTORS = np.random.default_rng(4).integers(1 << 62, size=(BANDS * BAND, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(text: str, found: list[dict]) -> list[int]:
    """Bands of minima over the word pairs of a text without its values; near copies share one."""
    import xxhash

    ws = masked(text, [(f["from"], f["end"]) for f in found], " ").split()
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in ws] or [0], np.uint64)
    if len(h) > 1:
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    h ^= h >> np.uint64(31)
    least = [(h * a + b).min() for a, b in _FACTORS]
    return [xxhash.xxh3_64_intdigest(np.array(least[i:i + BAND]).tobytes()) - (1 << 63)
            for i in range(0, len(least), BAND)]


def find(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """``(row, doc_id, text_hash, owner, repository, found, sketch)`` per row; one pass, no shuffle."""
    def run(batches):
        import pyarrow.compute as pc
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()),
                                   ("from", pa.int32()), ("value", pa.string()), ("live", pa.bool_()),
                                   ("marked", pa.bool_())]))
        for b in batches:
            maybe = pc.match_substring_regex(b.column(4), _MAYBE).to_pylist()
            found = [candidates(t.as_py()) if m else [] for m, t in zip(maybe, b.column(4))]
            bands = [sketch(t.as_py(), f) if f else [] for t, f in zip(b.column(4), found)]
            rows = pa.array(range(row, row + b.num_rows), pa.int64())
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([rows, *b.columns[:4], pa.array(found, kind), pa.array(bands, pa.list_(pa.int64()))],
                                             names=["row", "doc_id", "text_hash", "owner", "repository", "found", "sketch"])

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(docs["text"]).alias("text_hash"),
                       F.coalesce(owner, F.lit("")).alias("owner"), F.coalesce(repository, F.lit("")).alias("repository"),
                       docs["text"].alias("text"))
    return rows.mapInArrow(run, "row bigint, doc_id bigint, text_hash bigint, owner string, repository string, "
                                f"found {_FOUND}, sketch array<bigint>")


def ownership(spans: DataFrame) -> DataFrame:
    """``(value, n_repositories, n_owners)``: distinct counts in three combining steps."""
    return (spans.groupBy("value", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("value", "owner").agg(F.count(F.lit(1)).alias("r"))
            .groupBy("value").agg(F.sum("r").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners")))


def distinct_count(rows: DataFrame, column: str, name: str) -> DataFrame:
    """``(value, name)``: distinct values of a column, in two combining steps."""
    return (rows.groupBy("value", column).agg(F.count(F.lit(1)).alias("n")).groupBy("value").agg(F.count(F.lit(1)).alias(name)))


def near_copies(rows: DataFrame, held: DataFrame) -> DataFrame:
    """``(node, root)`` of the texts of ``held`` that share a band with another: the group's smallest hash."""
    bands = materialise(rows.where("size(found) > 0").select("text_hash", F.posexplode("sketch").alias("band", "least"))
                        .join(broadcast_if_small(held, 16), "text_hash", "left_semi").distinct(), "secret-bands")
    first = materialise(bands.groupBy("band", "least").agg(F.min("text_hash").alias("first"), F.count(F.lit(1)).alias("n"))
                        .where("n > 1").drop("n"), "secret-first")
    edges = bands.join(broadcast_if_small(first, 32), ["band", "least"]).select(
        F.col("text_hash").alias("src"), F.col("first").alias("dst"))
    return components(edges, "secret-copies")


def holders(rows: DataFrame, flat: DataFrame) -> DataFrame:
    """``(value, n_owners, n_repositories, n_classes)`` of every value."""
    texts = materialise(flat.groupBy("value", "text_hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
                        .drop("n"), "secret-texts")
    counts = materialise(ownership(texts).join(distinct_count(texts, "text_hash", "n_texts"), "value"), "secret-counts")
    # only where several owners hold several texts does it matter which of these are copies
    several = counts.where("n_owners > 1 and n_texts > 1").select("value")
    open_ = materialise(texts.join(broadcast_if_small(several, 96), "value", "left_semi"), "secret-open")
    held = materialise(open_.select("text_hash").distinct(), "secret-held")
    group = materialise(near_copies(rows, held), "secret-groups")
    classed = (open_.join(broadcast_if_small(group, 32), F.col("text_hash") == F.col("node"), "left")
               .withColumn("class", F.coalesce("root", "text_hash")))
    return (counts.join(distinct_count(classed, "class", "n_merged"), "value", "left")
            .select("value", "n_owners", "n_repositories", F.coalesce("n_merged", "n_texts").alias("n_classes")))


def verdict_of(example_owners: int = EXAMPLE_OWNERS) -> Column:
    """The verdict of a value from its counts and its looks (``live``, ``marked``)."""
    several = F.col("n_owners") > 1
    return (F.when(F.col("marked"), F.when(several, "example").otherwise("marked"))
            .when(~several, F.when(F.col("live"), "owner_live").otherwise("owner_plain"))
            .when(F.col("n_classes") == 1, "copied_with_text")
            .when(F.col("live"), "leaked")
            .when(F.col("n_owners") >= example_owners, "example").otherwise("shared"))


def spans(docs: DataFrame, owner: Column | None = None, repository: Column | None = None,
          example_owners: int = EXAMPLE_OWNERS) -> tuple[DataFrame, DataFrame]:
    """(rows found, judged spans): the second has a row per span of (row, start, kind, end, from, verdict, counts).

    A document table has no repository of its own: by default the source owns it and the
    (source, language) pair is its repository.
    """
    owner = docs["source"] if owner is None else owner
    repository = F.concat_ws("/", docs["source"], docs["lang"]) if repository is None else repository
    rows = materialise(find(docs, owner, repository), "secret-rows")
    flat = rows.where("size(found) > 0").select("row", "doc_id", "text_hash", "owner", "repository",
                                                F.inline("found"))
    owned = materialise(holders(rows, flat), "secret-owners")
    judged = (flat.join(broadcast_if_small(owned, 160), "value")
              .select("row", "doc_id", "text_hash", "start", "kind", "end", "from", verdict_of(example_owners).alias("verdict"),
                      "n_owners", "n_repositories", "n_classes"))
    return rows, materialise(judged, "secret-spans")


_SPAN = "struct<start:int,kind:int,end:int,verdict:string,n_owners:bigint,n_repositories:bigint,n_classes:bigint>"


def _joined(found: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, **options) -> DataFrame:
    """A row per document: counts by kind, digests of the base and of all spans, and for every span its verdict and holders.

    ``verdicts`` and ``holders`` (owners/repositories/classes) stand in the order of ``spans``.
    """
    rows, judged = spans(docs, **options)
    per_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "start", "kind", "end", "verdict", "n_owners", "n_repositories", "n_classes"))).alias("s"))
    every = F.coalesce("s", F.array().cast(f"array<{_SPAN}>"))
    base = F.filter(every, lambda s: s["kind"] < 3)
    count = lambda test: F.size(F.filter(every, test)).cast("bigint")
    of_kind = lambda k: count(lambda s: s["kind"] == k)
    held = F.array_join(F.transform(every, lambda s: F.concat_ws("/", *[s[c].cast("string") for c in (
        "n_owners", "n_repositories", "n_classes")])), ",")
    return rows.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id", *[of_kind(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(every).alias("spans"),
        count(lambda s: s["verdict"] == "owner_live").alias("n_live"),
        count(lambda s: s["verdict"] == "example").alias("n_example"),
        F.array_join(F.transform(every, lambda s: s["verdict"]), ",").alias("verdicts"), held.alias("holders"))


def masked(text: str, cuts: list[tuple[int, int]], mask: str) -> str:
    """``text`` with ``mask`` in place of each of the merged ``cuts``; linear in its length."""
    pieces, at = [], 0
    for start, end in sorted(cuts):
        if end > at:
            if start >= at:
                pieces += [text[at:start], mask]
            at = end
    return "".join([*pieces, text[at:]])


def _masker(mask: str):
    @F.arrow_udf("string")
    def run(text: pa.Array, cuts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else masked(t, [(c["s"], c["e"]) for c in cut], mask)
                         for t, cut in zip(text.to_pylist(), cuts.to_pylist())], pa.string())
    return run


def redact(docs: DataFrame, mask: str = "[SECRET]", **options) -> DataFrame:
    """The rows and columns of ``docs`` with every value masked that is not an example.

    Documents meet their spans by (doc_id, text hash); equal rows have equal spans.
    """
    _, judged = spans(docs, **options)
    cut, cut_id, cut_hash = (fresh(n, docs) for n in ("cuts", "cut_id", "cut_hash"))
    cuts = materialise(judged.where("verdict <> 'example'").groupBy("doc_id", "text_hash")
                       .agg(F.collect_set(F.struct(F.col("from").alias("s"), F.col("end").alias("e"))).alias(cut)),
                       "secret-cuts").withColumnsRenamed({"doc_id": cut_id, "text_hash": cut_hash})
    joined = docs.join(broadcast_if_small(cuts, 64, F.size(cut) * 24), docs["doc_id"].cast("bigint").eqNullSafe(F.col(cut_id))
                       & (F.xxhash64(docs["text"]) == F.col(cut_hash)), "left").drop(cut_id, cut_hash)
    masked = _masker(mask)(F.when(F.col(cut).isNotNull(), F.col("text")), F.col(cut))  # other texts stay in the JVM
    out = joined.withColumn("text", F.coalesce(masked, F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(cut).isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
