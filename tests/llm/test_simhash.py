"""SimHash groups against brute force: fingerprints bit by bit, links by all pairs."""

import collections
import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from hearth.llm import simhash
from tests.conftest import SF001


def slow_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    grams = [" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)] or ([" ".join(ws)] if ws else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids_fps, radius=3):
    fps = sorted({f for _, f in ids_fps})
    up = {f: f for f in fps}

    def find(f):
        while up[f] != f:
            f = up[f]
        return f
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                up[find(a)] = find(b)
    least = {}
    for i, f in ids_fps:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return sorted(((i, f, least.get(find(f))) for i, f in ids_fps), key=str)


def got(df):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in df.collect()), key=str)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbZ \t\n\x0b\x1c é漢", max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) % (1 << 64) == slow_fingerprint(text)


def test_masks_cover_every_set_of_radius_positions():
    masks = [m % (1 << 64) for m in simhash.covering_masks(3)]
    assert len(masks) == 15
    for a in range(64):
        for b in range(a, 64):
            for c in range(b, 64):
                off = 1 << a | 1 << b | 1 << c
                assert any(not m & off for m in masks)


def test_sf_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in docs.collect()])
    assert got(simhash.simhash_groups(docs)) == want


def test_links_of_crowded_buckets_in_small_blocks(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(4)]
    fps = {s ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for s in seeds for _ in range(60)} | set(seeds)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(df, block=8).collect()
    assert all((e.src ^ e.dst) % (1 << 64) for e in edges)
    up = {f: f for f in signed}

    def find(f):
        while up[f] != f:
            f = up[f]
        return f
    for e in edges:
        up[find(e.src)] = find(e.dst)
    mine = collections.Counter(find(f) for f in signed)
    want = collections.Counter(c for _, _, c in slow_components([(i, f % (1 << 64)) for i, f in enumerate(signed)]))
    assert sorted(mine.values()) == sorted(want.values())


def test_odd_rows(spark, odd_docs, no_docs):
    want = slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in odd_docs.collect()])
    assert got(simhash.simhash_groups(odd_docs)) == want
    assert simhash.simhash_groups(no_docs).count() == 0


def test_deduplicate_keeps_one_of_each_group(odd_docs, no_docs):
    kept = simhash.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    # 1, 6 and 6 are equal; the null text, the empty text and the null id without text are one group
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 4, 5, None, 8, 9, 10, 11]))
    assert simhash.deduplicate(no_docs).count() == 0
