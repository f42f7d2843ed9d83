"""Ranked lexical search with hashed max-sketches.

Scores are sums over a query's terms of weight(term) * impact(term, document); the impact grows
with the term's frequency and falls with the document's length, both as integers. Documents are
counted once into a written index of (document, words, terms, frequencies). The searching pass
folds the impacts of all terms of a document into a sketch of ``width`` coordinates: a term's
hash names its coordinate, which keeps the largest impact that falls there. So a coordinate is
never below the impact of a term that belongs to it, and a query's weights, folded the same way,
times the sketch bound the document's score from above. One product of a block of sketches with
the folded queries gives all bounds at once. Each query then takes the documents of the block by
falling bound, scores them exactly by their terms, and stops where the bound falls below its k-th
best score so far. What a task keeps is k documents a query; their ranks are a window over these.

Queries are taken in blocks of about ``QUERY_TERMS`` query terms; a block and the weights of its
terms are the only things that pass the driver, and each block is one pass over the index.

Defined results: a null or empty text has no term and is never found, nor finds anything; a
document that shares no weighty term with a query is not listed; equal scores rank by document
id, rows without an id last; repeated document rows are listed each; every query row is ranked
by itself, also when ids repeat; empty tables give an empty result; columns other than the id
and the text are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, materialise, pick

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
K = 20
WIDTH = 4096             # coordinates of a sketch
QUERY_TERMS = 1 << 17    # query terms in a block of queries
DOC_ROWS = 1024          # documents whose sketches are held at once
DOC_TERMS = 1 << 20      # and at most so many of their terms (one document at least)
FIRST = 32               # documents scored at first; then twice as many each time


def tally(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(key, n, terms, tfs)`` of every row that has a term: words with repeats, distinct terms, frequencies."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            rows, n, terms, tfs, ends = [], [], [], [], [0]

            def table():
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, t))
                         for v, t in ((terms, pa.string()), (tfs, pa.int64()))]
                return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), *lists],
                                                  names=[key, "n", "terms", "tfs"])

            for i, t in enumerate(pc.ascii_lower(b.column(1))):
                counts = Counter(TERM.findall(t.as_py() or ""))
                if counts:
                    rows.append(i)
                    terms.extend(counts)
                    tfs.extend(counts.values())
                    n.append(sum(counts.values()))
                    ends.append(len(terms))
                if len(terms) >= DOC_TERMS:
                    yield table()
                    rows, n, terms, tfs, ends = [], [], [], [], [0]
            yield table()

    rows = pick(rows, key, text).select(F.col(key).cast("bigint"), text)
    return rows.mapInArrow(run, f"{key} bigint, n bigint, terms array<string>, tfs array<bigint>")


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def lengths(n: list[int], documents: int, words: int) -> np.ndarray:
    """Relative lengths in hundredths, damped (exact for any counts)."""
    return np.array([100 - 25 + 25 * x * documents // words for x in n], np.int64)


def coordinate(term: str, width: int) -> int:
    return zlib.crc32(term.encode("utf-8")) % width


class Queries:
    """A block of queries: their terms, weights (times repeats) and folded weights."""

    def __init__(self, rows: list[tuple[int, list[str], list[int]]], width: int):
        self.ids = [r[0] for r in rows]
        self.term: dict[str, int] = {}
        self.terms, self.weights = [], []
        for _, terms, weights in rows:
            self.terms.append(np.array([self.term.setdefault(t, len(self.term)) for t in terms], np.int64))
            self.weights.append(np.array(weights, np.int64))
        self.width = width
        self.folded = np.zeros((width, len(rows)), np.float32)
        at = np.array([coordinate(t, width) for t in self.term], np.int64)
        for q, (t, w) in enumerate(zip(self.terms, self.weights)):
            np.add.at(self.folded[:, q], at[t], w)


class Docs:
    """A block of documents: sketches and the exact impacts of the queries' terms."""

    def __init__(self, part, queries: Queries, documents: int, words: int):
        import pyarrow as pa
        import pyarrow.compute as pc
        ids = part.column(0)
        self.void = np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(0))
        terms, tfs = part.column(2), part.column(3).flatten().to_numpy()
        counts = pc.list_value_length(terms).to_numpy()
        m = lengths(part.column(1).to_pylist(), documents, words)
        row = np.repeat(np.arange(part.num_rows), counts)
        value = impacts(tfs, m[row])
        coded = terms.flatten().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        known = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy()
        at = np.array([coordinate(t, queries.width) for t in known], np.int64)[code]
        sketch = np.zeros((part.num_rows, queries.width), np.float32)
        np.maximum.at(sketch.reshape(-1), row * queries.width + at, value.astype(np.float32))
        self.sketch = sketch
        asked = np.array([queries.term.get(t, -1) for t in known], np.int64)[code]
        used = asked >= 0
        self.span = max(1, len(queries.term))
        keys = row[used] * self.span + asked[used]
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], value[used][order]

    def scores(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of some documents for one query."""
        wanted = rows[:, None] * self.span + terms
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return (np.where(self.keys[at] == wanted, self.values[at], 0) * weights).sum(axis=1)


class Best:
    """The k best (score, document) of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = [np.zeros(0, np.int64)] * queries
        self.ids = [np.zeros(0, np.int64)] * queries
        self.void = [np.zeros(0, bool)] * queries
        self.least = np.ones(queries, np.int64)     # a score that can still enter

    def take(self, q: int, score: np.ndarray, ids: np.ndarray, void: np.ndarray) -> None:
        good = score >= self.least[q]
        if not good.any():
            return
        score, ids, void = (np.append(old, new[good]) for old, new in
                            ((self.score[q], score), (self.ids[q], ids), (self.void[q], void)))
        order = np.lexsort((ids, void, -score))[:self.k]
        self.score[q], self.ids[q], self.void[q] = score[order], ids[order], void[order]
        if len(order) == self.k:
            self.least[q] = max(1, int(score[order[-1]]))


def upper_bounds(docs: Docs, queries: Queries) -> np.ndarray:
    """Bounds of every (document, query); raised by what single precision can lose in so long a sum."""
    return docs.sketch @ queries.folded * np.float32(1 + queries.width * np.finfo(np.float32).eps)


def search_block(docs: Docs, queries: Queries, best: Best) -> int:
    """Enter the documents of a block; returns how many exact scores it took."""
    taken = 0
    if not len(docs.keys):
        return taken
    bounds = upper_bounds(docs, queries)
    for q in range(len(queries.ids)):
        bound = bounds[:, q]
        rows = np.flatnonzero(bound >= best.least[q])
        rows = rows[np.argsort(-bound[rows], kind="stable")]
        step = FIRST
        while len(rows) and bound[rows[0]] >= best.least[q]:
            now, rows = rows[:step], rows[step:]
            now = now[bound[now] >= best.least[q]]
            best.take(q, docs.scores(now, queries.terms[q], queries.weights[q]), docs.ids[now], docs.void[now])
            taken += len(now)
            step *= 2
    return taken


def _parts(batch) -> Iterator:
    """Slices of a batch of at most ``DOC_ROWS`` documents and ``DOC_TERMS`` terms."""
    import pyarrow.compute as pc
    begin, held = 0, 0
    for i, c in enumerate(pc.list_value_length(batch.column(2)).to_pylist()):
        if i > begin and (held + c > DOC_TERMS or i - begin >= DOC_ROWS):
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += c
    if begin < batch.num_rows:
        yield batch.slice(begin)


def _search(index: DataFrame, queries: Queries, documents: int, words: int, k: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        best = Best(len(queries.ids), k)
        for b in batches:
            for part in _parts(b):
                search_block(Docs(part, queries, documents, words), queries, best)
        counts = [len(s) for s in best.score]
        found = lambda v, t: np.concatenate(v).astype(t) if v else np.zeros(0, t)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(queries.ids, np.int64), counts)), pa.array(found(best.score, np.int64)),
             pa.array(found(best.ids, np.int64), mask=found(best.void, bool))], names=["_query", "score", "doc_id"])

    return index.mapInArrow(run, "_query bigint, score bigint, doc_id bigint")


def index(docs: DataFrame) -> DataFrame:
    """The written index of ``docs(doc_id, text)``."""
    return materialise(tally(docs, "doc_id"), "lexical-index")


def search(docs: DataFrame, queries: DataFrame, k: int = K, width: int = WIDTH, query_terms: int = QUERY_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k best documents of every row of ``queries(item_id, text)``."""
    indexed = index(docs)
    documents, words = indexed.agg(F.count(F.lit(1)), F.sum("n")).first()
    asked = materialise(tally(queries, "item_id").withColumn("_query", F.monotonically_increasing_id()), "lexical-queries")
    wanted = materialise(asked.select(F.explode("terms").alias("term")).distinct(), "lexical-terms")
    terms, term_bytes = wanted.agg(F.count(F.lit(1)), F.sum(F.octet_length("term"))).first()
    if not documents or not terms:
        return indexed.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    if term_bytes + 32 * terms <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    df = materialise(indexed.select(F.explode("terms").alias("term")).join(wanted, "term", "left_semi")
                     .groupBy("term").agg(F.count(F.lit(1)).alias("df")), "lexical-df")
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")))
    weighed = (asked.select("_query", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
               .select("_query", F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf"))
               .join(df, "term").withColumn("w", (F.col("tf") * weight).cast("bigint")).where("w > 0"))
    weighed = materialise(weighed.select("_query", "term", "w"), "lexical-weights")
    blocks = max(1, -(-weighed.count() // query_terms))
    found = []
    for block in range(blocks):
        rows = (weighed.where(F.pmod(F.xxhash64("_query"), F.lit(blocks)) == block).groupBy("_query")
                .agg(F.collect_list(F.struct("term", "w")).alias("ts")).collect())
        rows = sorted((r._query, [t.term for t in r.ts], [t.w for t in r.ts]) for r in rows)
        part = _search(indexed, Queries(rows, width), documents, words, k)
        found.append(part if blocks == 1 else materialise(part, "lexical-found"))
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    order = Window.partitionBy("_query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(asked.select("_query", "item_id"), "_query").select("item_id", "rank", "doc_id", "score")
