import numpy as np
import pyarrow.parquet as pq

from hearth.llm import quality, queries
from tests.conftest import SF001, SF01


def _labelled():
    d = pq.read_table(f"{SF01}/documents.parquet").to_pandas()
    m = d.merge(pq.read_table(f"{SF01}/labels.parquet").to_pandas(), on="doc_id").sort_values("doc_id")
    y = np.where(m.quality == 0, 0, np.where(m.toxic == 1, 1, 2))
    return [quality.features(t.encode()) for t in m.text], y


def test_held_out_accuracy():
    x, y = _labelled()
    odd = np.arange(len(y)) % 4 == 3
    model = quality.fit([f for f, o in zip(x, odd) if not o], y[~odd])
    assert np.all(np.diff(model.thresholds) > 0)
    tail = model.tails(np.array([model.score(f) for f, o in zip(x, odd) if o]))[:, -1]
    keep, true = tail >= quality.KEEP_TAIL, y[odd]
    assert keep[true == 2].mean() > 0.93
    assert keep[true == 0].mean() < 0.15


def test_thresholds_and_tails_are_ordered():
    x, y = _labelled()
    model = quality.fit(x, y)
    t = model.tails(np.linspace(-10, 10, 50))
    assert np.all(t[:, 0] >= t[:, 1]) and np.all(np.diff(t, axis=0) >= 0)


def loss(w, cuts, rows, y, l2):
    """Mean negative log likelihood of the grades and the penalty, term by term."""
    total = 0.0
    for r, g in zip(rows, y):
        s = sum(w[i] for i in r)
        at_most = [1 / (1 + np.exp(s - c)) for c in cuts] + [1.0]
        total -= np.log(at_most[g] - (at_most[g - 1] if g else 0.0))
    return total / len(rows) + l2 / (2 * len(rows)) * sum(x * x for x in w)


def gradient(w, cuts, rows, y, l2, step=1e-5):
    """Central differences of the loss in every weight and threshold."""
    out = []
    for x in (w, cuts):
        for i in range(len(x)):
            up, down = x.copy(), x.copy()
            up[i] += step
            down[i] -= step
            args = ((up, cuts), (down, cuts)) if x is w else ((w, up), (w, down))
            out.append((loss(*args[0], rows, y, l2) - loss(*args[1], rows, y, l2)) / (2 * step))
    return np.array(out)


def test_fit_reaches_the_least_loss_of_a_slow_fit():
    """Where the fit ends the loss is flat by finite differences, and plain descent along them gets no lower."""
    rng = np.random.default_rng(3)
    used, l2 = 5, 6.0
    rows = [rng.choice(used, 2, replace=False).astype(np.int32) for _ in range(60)]
    truth = rng.normal(size=used) * 1.5
    y = np.digitize([truth[r].sum() + rng.logistic() for r in rows], [-1.0, 1.0])
    model = quality.fit(rows, y, epochs=4000, l2=l2, min_docs=1)
    w, cuts = model.weights[:used].copy(), model.thresholds.copy()
    assert not model.weights[used:].any()
    assert np.abs(gradient(w, cuts, rows, y, l2)).max() < 2e-3
    slow_w, slow_cuts = np.zeros(used), np.array([-1.0, 1.0])
    for _ in range(400):
        g = gradient(slow_w, slow_cuts, rows, y, l2)
        slow_w, slow_cuts = slow_w - 1.0 * g[:used], slow_cuts - 1.0 * g[used:]
    assert loss(w, cuts, rows, y, l2) <= loss(slow_w, slow_cuts, rows, y, l2) + 1e-4
    assert np.allclose(w, slow_w, atol=0.05) and np.allclose(cuts, slow_cuts, atol=0.05)


def test_op9_against_term_by_term_scoring(spark):
    """Expected grade and tail of every document from its features, weights and thresholds, one by one."""
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    got = {r.doc_id: r for r in quality.score(docs.select("doc_id", "text"), model).collect()}
    for r in docs.collect():
        s = sum(float(model.weights[i]) for i in quality.features((r.text or "").encode()))
        tails = [1 / (1 + np.exp(c - s)) for c in model.thresholds]
        assert abs(got[r.doc_id]._expected - sum(tails)) < 1e-9 and abs(got[r.doc_id]._tail - tails[-1]) < 1e-9
        assert got[r.doc_id]._keep == (got[r.doc_id]._tail >= quality.KEEP_TAIL)
    again = {r.doc_id: r.selected for r in queries.op9_quality(spark, SF001).collect()}
    assert again == {i: r._keep for i, r in got.items()}


def test_fit_separates_grades():
    rng = np.random.default_rng(1)
    rows = [rng.choice(40, 6, replace=False).astype(np.int32) for _ in range(80)]
    truth = rng.normal(size=40)
    y = np.digitize([truth[r].sum() for r in rows], [-1.0, 1.0])
    model = quality.fit(rows, y, epochs=400, l2=1e-3, min_docs=1)
    right = np.mean([np.digitize(model.score(r), model.thresholds) == g for r, g in zip(rows, y)])
    assert right > 0.9


def test_grades(spark):
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 1), (3, 1, 0), (3, 0, 0), (4, None, 1), (None, 1, 0), (5, 1, None)],
                                   "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.grade for r in quality.grades(labels).collect()} == {1: 0, 2: 1, 3: 0, 5: 2}


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    model = quality.train(spark.read.parquet(f"{SF01}/documents.parquet"), labels)
    scored = quality.score(odd_docs, model)
    assert scored.columns[:len(odd_docs.columns)] == odd_docs.columns
    rows = scored.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r._tail <= r._expected <= 2 for r in rows)
    assert quality.select(no_docs, labels).count() == 0
    assert quality.select(odd_docs, labels.limit(0)).count() == odd_docs.count()  # neutral model
