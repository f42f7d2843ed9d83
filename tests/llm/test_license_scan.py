import re

from hypothesis import given, settings
from hypothesis import strategies as st

from hearth.llm import license_scan
from tests.conftest import SF01

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def slow(text):
    ws = WORD.findall(lower(text))
    out = []
    for phrase, label in license_scan.BASE:
        p = phrase.split()
        out += [(i, label) for i in range(len(ws)) if ws[i:i + len(p)] == p]
    return ws, sorted(out)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ09 \n-_`{é漢\x7f\x00", max_size=30))
def test_words(text):
    assert [w.decode() for w in license_scan.words(text.encode())] == slow(text)[0]


def check(docs):
    got = sorted(license_scan.scan(docs).collect(), key=lambda r: (str(r.doc_id), r.n_words))
    rows = sorted(docs.collect(), key=lambda r: (str(r.doc_id), len(slow(r.text)[0])))
    assert len(got) == len(rows)
    for g, r in zip(got, rows):
        ws, places = slow(r.text)
        base = sorted({label for _, label in places})
        assert (g.doc_id, g.n_words, g.n_base) == (r.doc_id, len(ws), len(places))
        assert (g.first_word, g.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert g.base_labels == ",".join(base) and set(base) <= set(g.labels.split(","))
        assert sorted(set(g.labels.split(","))) == g.labels.split(",") and 0 <= g.score <= 1
        for s in g.spans:
            assert 0 <= s.start < s.end <= len(ws) and s.score >= license_scan.LEAST_SCORE
    return {g.doc_id: g for g in got}


def test_sf_base_and_method_labels(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = check(docs)
    gpl = {r.doc_id for r in docs.where("text like '%GNU General Public License, version 3%'").collect()}
    assert gpl and {i for i, g in got.items() if "gpl-3" in g.labels.split(",")} == gpl
    clean = {r.doc_id for r in docs.where("lower(text) not like '%licens%' and lower(text) not like '%cc by%'").collect()}
    assert not any(got[i].labels for i in clean)


def test_neighbouring_diagonals_of_an_edited_notice(spark):
    mit = license_scan.TEMPLATES[1][1]
    edited = mit.replace("free of charge", "free of any charge").replace("a copy", "one copy").replace("without limitation ", "")
    texts = [f"intro words here {mit} outro", f"x y z {edited} w", "permission is hereby granted to nobody", mit + " filler " * 50 + edited]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = check(docs)
    assert [got[i].labels for i in range(4)] == ["mit", "mit", "", "mit"]
    assert (got[0].spans[0].start, got[0].spans[0].end, got[0].spans[0].score) == (3, 3 + len(slow(mit)[0]), 1.0)
    assert 0.8 <= got[1].score < 1 and len(got[3].spans) == 2


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert license_scan.scan(no_docs).count() == 0


def test_copies_do_not_add_up_votes(spark):
    text = "released under the terms of nothing, permission is hereby granted to nobody at all"
    one = spark.createDataFrame([(1, text)], "doc_id long, text string")
    many = spark.createDataFrame([(1, text)] * 40, "doc_id long, text string")
    loose, strict = (set(license_scan.regions(one, least_votes=v).collect()) for v in (0.05, 0.25))
    assert loose > strict
    assert set(license_scan.regions(many, least_votes=0.05).collect()) == loose
    assert set(license_scan.regions(many, least_votes=0.25).collect()) == strict


def test_many_places_in_one_text(spark):
    text = "cc by nc under the mit license " * 20_000
    row = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (140_000, 40_000, 0, 139_996)


def test_merged_repeats_are_verified_one_by_one(spark):
    """A run of a notice without its first word merges into one region; scattered words never add up."""
    run = "x " + "under the MIT License " * 400 + "y"
    scattered = " ".join(f"permission is hereby w{i} w{i + 1}" for i in range(0, 3000, 2))
    docs = spark.createDataFrame([(1, run), (2, scattered)], "doc_id long, text string")
    got = check(docs)
    assert got[1].labels == "mit" and got[1].n_base == 400 and len(got[1].spans) > 50
    assert all(s.end - s.start <= 2 * (5 + license_scan.BAND) for s in got[1].spans)
    assert not got[2].labels and not got[2].spans


def _labels(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = check(docs)
    return [got[i].labels for i in range(len(texts))]


def test_words_inserted_or_left_out_at_one_place(spark):
    ws = license_scan.TEMPLATES[1][1].split()
    texts = [" ".join(["intro", *ws[:25], *[f"w{i}" for i in range(n)], *ws[25:], "outro"]) for n in (4, 5, 9, 14)]
    texts += [" ".join(["intro", *ws[:22], *ws[22 + n:], "outro"]) for n in (5, 8)]
    assert _labels(spark, texts) == ["mit"] * 6


def test_other_licenses_notices_get_no_label(spark):
    cc = "This work is licensed under a Creative Commons Attribution"
    gnu = "This work is licensed under the GNU"
    texts = ["Released under the BSD License.", "Released under the Apache License.", "Licensed under CC BY 4.0.",
             "Licensed under CC BY-SA 4.0.", f"{cc}-ShareAlike 4.0 International License.",
             f"{cc}-NonCommercial-ShareAlike 4.0 International License.",
             f"{gnu} Lesser General Public License, version 3.", f"{gnu} General Public License, version 2.",
             license_scan.TEMPLATES[8][1].replace("version 3", "version 2"),
             license_scan.TEMPLATES[8][1].replace("General", "Lesser General")]
    assert _labels(spark, texts) == [""] * len(texts)
    texts = [f"{cc}-NonCommercial 4.0 International License.", f"{cc} 4.0 International License.",
             f"{cc}-Non-Commercial 3.0 International License.", f"{gnu} General Public License v3.",
             *[t for _, t in license_scan.TEMPLATES]]
    assert _labels(spark, texts) == ["cc-by-nc", "cc-by", "cc-by-nc", "gpl-3", *[label for label, _ in license_scan.TEMPLATES]]
