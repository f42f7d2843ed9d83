"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Ratings are grades 0 (junk), 1 (well-formed but toxic) and 2 (clean). One weight vector
over hashed text features is shared by all grades; ordered thresholds cut the score:
P(grade <= k) = sigmoid(threshold_k - w.x). That gives every document an expected grade
and the tail probability P(grade >= 2), on which it is selected.

The model is fitted on a bounded sample of labelled rows (``max_labelled``, smallest id
hashes first, repeated rows once); every document is scored over its whole text.

Defined results: a null or blank text has only the empty-text features; labels without a
document, with a null quality, or given twice with different grades take the lowest grade
given (nulls ignored); with no usable label the model is neutral and keeps every document;
repeated rows get equal scores; an empty table gives an empty result; columns other than
doc_id and text are not looked at (``select`` keeps them all).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise, pick

DIM = 1 << 18
MAX_LABELLED = 12_000
MIN_DOCS = 12          # a hashed feature enters the model from this many sampled documents
GRADES = 3
L2 = 2.4               # ridge penalty on the summed loss, so few ratings are smoothed more
KEEP_TAIL = 0.4        # a document stays when P(grade >= 2) reaches this

_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_SYMBOL = b"&%$#*|<>=~^_{}[]@\\"
_STRIP = b".,;:!?\"'()"


def features(text: bytes) -> np.ndarray:
    """Hashed feature ids (distinct) of one whole text: its words, and binned shape measures."""
    words = text.split()
    vocabulary = set(text.lower().split())
    n, size = len(words), max(1, len(text))
    shape = (
        ("upper", int(20 * (size - len(text.translate(None, _UPPER))) / size)),
        ("digit", int(20 * (size - len(text.translate(None, _DIGIT))) / size)),
        ("symbol", int(40 * (size - len(text.translate(None, _SYMBOL))) / size)),
        ("bang", int(40 * text.count(b"!") / size)),
        ("distinct", int(10 * len(vocabulary) / max(1, n)) if n >= 20 else -1),
        ("lines", int(10 * len(set(text.split(b"\n"))) / (1 + text.count(b"\n")))),
        ("words", n.bit_length()),
    )
    crc, mask = zlib.crc32, DIM - 1
    ids = {crc(w.strip(_STRIP)) & mask for w in vocabulary}
    ids.update(crc(f"\x00{k}:{v}".encode()) & mask for k, v in shape)
    return np.fromiter(ids, np.int32, len(ids))


@dataclass
class OrdinalModel:
    weights: np.ndarray      # float64[DIM]
    thresholds: np.ndarray   # float64[GRADES - 1], increasing

    def score(self, ids: np.ndarray) -> float:
        return float(self.weights[ids].sum())

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. GRADES-1, one row per score."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - np.asarray(score)[:, None], -40, 40)))


NEUTRAL = OrdinalModel(np.zeros(DIM), np.array([-2.0, -1.0]))


def fit(rows: list[np.ndarray], grades: np.ndarray, epochs: int = 120, l2: float = L2,
        min_docs: int = MIN_DOCS) -> OrdinalModel:
    """Full-batch Adam on the mean cumulative-link log loss; grades 0 .. GRADES-1."""
    if not len(rows):
        return NEUTRAL
    n = len(rows)
    ids = np.concatenate(rows)
    doc = np.repeat(np.arange(n), [len(r) for r in rows])
    known = np.bincount(ids, minlength=DIM) >= min_docs
    ids, doc = ids[known[ids]], doc[known[ids]]
    y = np.asarray(grades)
    w = np.zeros(DIM)
    share = np.array([(np.sum(y <= k) + 0.5) / (n + 1.0) for k in range(GRADES - 1)])
    base = np.log(share / (1 - share))
    theta = np.concatenate(([base[0]], np.log(np.maximum(np.diff(base), 1e-3))))  # first, then log gaps
    state = [np.zeros(DIM), np.zeros(DIM), np.zeros(GRADES - 1), np.zeros(GRADES - 1)]
    cum = lambda t: np.concatenate(([t[0]], t[0] + np.cumsum(np.exp(t[1:]))))
    for step in range(1, epochs + 1):
        cuts = cum(theta)
        s = np.bincount(doc, weights=w[ids], minlength=n)
        sig = 1 / (1 + np.exp(np.clip(s[:, None] - cuts[None, :], -40, 40)))  # P(grade <= k)
        upper = np.concatenate((sig, np.ones((n, 1))), 1)[np.arange(n), y]
        lower = np.concatenate((np.zeros((n, 1)), sig), 1)[np.arange(n), y]
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        gs = (du - dl) / n                       # d loss / d score
        gw = np.bincount(ids, weights=gs[doc], minlength=DIM) + l2 / n * w
        gc = np.array([-(du[y == k].sum()) + dl[y == k + 1].sum() for k in range(GRADES - 1)]) / n
        gt = np.concatenate(([gc.sum()], [gc[j:].sum() * np.exp(theta[j]) for j in range(1, GRADES - 1)]))
        for x, g, m, v, rate in ((w, gw, state[0], state[1], 0.05), (theta, gt, state[2], state[3], 0.05)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return OrdinalModel(w, cum(theta))


def grades(labels: DataFrame) -> DataFrame:
    """``(doc_id, grade)``: quality 0 -> 0; quality 1 and toxic -> 1; quality 1 and not toxic -> 2."""
    grade = (F.when(F.col("quality") == 0, 0).when(F.col("quality").isNull(), None)
             .when(F.col("toxic") == 1, 1).otherwise(2))
    return (pick(labels, "doc_id", "quality", "toxic").select(F.col("doc_id").cast("bigint"), grade.alias("grade"))
            .where("grade is not null and doc_id is not null").groupBy("doc_id").agg(F.min("grade").alias("grade")))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> OrdinalModel:
    """Fit on at most ``max_labelled`` labelled documents; texts become features on the executors."""
    docs = pick(docs, "doc_id", "text")
    # ids are ranked before any text is read; twice the bound, as a label may lack its document
    sample = materialise(grades(labels).join(docs.select(F.col("doc_id").cast("bigint")).distinct(), "doc_id", "left_semi")
                         .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled), "quality-sample")

    def run(batches):
        import pyarrow as pa
        for b in batches:
            ids = [features(t.as_py() or b"") for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([i.tobytes() for i in ids], pa.binary())],
                names=["doc_id", "grade", "ids"])

    rows = (docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
            .join(F.broadcast(sample), "doc_id").select("doc_id", "grade", "text")
            .mapInArrow(run, "doc_id bigint, grade int, ids binary"))
    # bounded by max_labelled documents; repeated ids count once
    got = rows.groupBy("doc_id").agg(F.min(F.struct("grade", "ids")).alias("r")).select("doc_id", "r.*").toArrow()
    got = got.sort_by("doc_id")
    return fit([np.frombuffer(x.as_py(), np.int32) for x in got["ids"]], got["grade"].to_numpy())


def score(docs: DataFrame, model: OrdinalModel, keep_tail: float = KEEP_TAIL) -> DataFrame:
    """All columns of ``docs``, then the expected grade, the tail probability and whether it is kept.

    The three last columns are ``_expected``, ``_tail`` and ``_keep``, lengthened by underscores where
    ``docs`` has such names. One pass, no shuffle.
    """
    from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

    schema = StructType([*docs.schema.fields, StructField(fresh("_expected", docs), DoubleType()),
                         StructField(fresh("_tail", docs), DoubleType()), StructField(fresh("_keep", docs), BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(
        (np.flatnonzero(model.weights).astype(np.int32), model.weights[model.weights != 0], model.thresholds))
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa
        ids, values, thresholds = shared.value
        weights = np.zeros(DIM)
        weights[ids] = values
        m = OrdinalModel(weights, thresholds)
        for b in batches:
            s = np.array([m.score(features((t.as_py() or "").encode())) for t in b.column(at)], float)
            tails = m.tails(s)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(tails.sum(1), pa.float64()), pa.array(tails[:, -1], pa.float64()),
                 pa.array(tails[:, -1] >= keep_tail)],
                names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def select(docs: DataFrame, labels: DataFrame, keep_tail: float = KEEP_TAIL,
           max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``docs`` whose tail probability reaches ``keep_tail``, all columns kept."""
    model = train(docs, labels, max_labelled)
    scored = score(docs, model, keep_tail)
    return scored.where(F.col(scored.columns[-1])).select(*docs.columns)
