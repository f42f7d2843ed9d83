"""The pipeline's stages against brute force, and the queries as registered."""

import re

import duckdb
import pytest

import corpus_pipeline
from hearth.llm import queries
from tests.conftest import SF001
from tests.llm.test_mixing import slow_targets
from tests.llm.test_packing import ids
from tests.llm.test_simhash import slow_components, slow_fingerprint

TABLES = ("documents", "pages", "embeddings", "labels", "benchmark")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF001)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(
        "Row(" + ", ".join(f"{c}={v!r}" for c, v in zip(want.columns, r)) + ")" for r in want.fetchall())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, seen = docs.columns, {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_dedup", "secret_scan", "source_mixing",
                                                      "harmonic_packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
        assert name == "harmonic_packing" or docs.columns == columns
    junk = {r.doc_id for r in spark.read.parquet(f"{SF001}/labels.parquet").where("quality = 0").collect()}
    kept = {r.doc_id for r in seen["quality_classifier"]}
    assert len(kept & junk) <= 1 and len(kept) > 140
    roots = slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in seen["quality_classifier"]])
    assert sorted(r.doc_id for r in seen["simhash_dedup"]) == sorted(i for i, _, c in roots if i == c)
    assert {r.doc_id for r in seen["secret_scan"]} == {r.doc_id for r in seen["simhash_dedup"]}
    secret = re.compile(r"token = \"[0-9a-f]{40}")
    assert not any(secret.search(r.text) for r in seen["secret_scan"])
    size, taken = {}, {}
    for rows, into in ((seen["secret_scan"], size), (seen["source_mixing"], taken)):
        for r in rows:
            into[r.source] = into.get(r.source, 0) + len(re.findall("[^\x20\x09-\x0d]+", r.text))
    assert taken == {s: int(t) for s, t in slow_targets(size).items()}
    assert sum(p.length for p in seen["harmonic_packing"]) == sum(len(ids(r.text)) for r in seen["source_mixing"])


LABELS = "doc_id long, quality int, toxic int"


def test_whole_run_on_odd_rows(spark, odd_docs, tmp_path):
    """Null, empty, repeated and very long texts through all stages: every kept word is packed, nothing crashes."""
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 1)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    rows = out.collect()
    assert {"doc_id", "sequence_id", "offset", "length", "ids"} <= set(out.columns)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.length == len(r.ids) <= 2048
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.text, []).append(r.doc_id)
    kept = {r.doc_id for r in rows}
    assert len(kept & {1, 6}) <= 1                      # equal texts are one document
    assert 8 in kept and len([r for r in rows if r.doc_id == 8]) > 10


def test_whole_run_on_empty_tables(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_entry_registers_the_queries():
    import __spark_entry__ as entry
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())
