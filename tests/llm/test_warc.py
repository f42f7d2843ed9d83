import hashlib
import io
import struct

import pytest
import zstandard

from hearth.llm import warc
from tests.conftest import SF01


def slow(rows):
    out, groups = [], {}
    for r in rows:
        b = (r.html or "").encode()
        groups.setdefault((hashlib.sha1(b).hexdigest(), len(b)), []).append(r.page_id)
    for (digest, n), ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i))
        for i in ids[:-1]:
            out.append((i, n, digest, "revisit" if n >= 1000 else "response", ids[-1] if n >= 1000 else None))
        out.append((ids[-1], n, digest, "response", None))
    return sorted(out, key=str)


def round_trip(spark, pages, **options):
    manifest = warc.write(pages, **options)
    got = [tuple(r)[:5] for r in warc.read(spark, manifest).collect()]
    assert sorted(got, key=str) == slow(pages.collect())
    return manifest


def test_sf_round_trip_with_several_archives(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    assert round_trip(spark, pages, archive_bytes=200_000).count() > 2


def test_revisits_ties_and_odd_rows(spark):
    big, other = "ü" * 600, "x" * 5000
    rows = [(1, "http://a/ b\r\nc", big), (5, "http://b", big), (3, None, big), (9, "u", other), (9, "u", other), (9, "v", other),
            (None, "n", big), (2, "s", "small"), (4, "s", "small"), (6, "e", ""), (7, "z", None), (8, "z", "y" * 1000), (8, "z", "y" * 1000),
            (11, "nul", "a\x00b\r\n\r\nWARC/1.1\r\n"), (None, None, "q" * 1000), (None, None, "q" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url as digest", "page_id as size")
    round_trip(spark, pages)
    assert warc.read(spark, warc.write(pages.limit(0))).count() == 0


def test_hot_payload(spark):
    pages = spark.range(900).selectExpr("id as page_id", "'u' as url",
                                        "case when id % 3 = 0 then repeat('hot', 500) else concat(repeat('z', 990), id) end as html")
    round_trip(spark, pages)


def test_archive_layout():
    records = [warc.record(i, f"http://x/{i}", hashlib.sha1(b"p%d" % i * 300).hexdigest(), len(b"p%d" % i * 300), "response", None,
                           b"p%d" % i * 300, "0", warc.DATE) for i in range(200)]
    data = warc.archive(records)
    magic, n = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and data[8:12] == bytes.fromhex("37a430ec")  # skippable frame holding a dictionary
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + n]))
    first = d.decompressobj()
    assert first.decompress(data[8 + n:]) == records[0]  # a frame for each record
    assert [b.partition(b"\r\n\r\n")[2] for _, b in warc.read_archive(io.BytesIO(data))] == [b"p%d" % i * 300 for i in range(200)]
    for n in (1, 2, 3, 15, 16):       # too few to train on: their raw content is the dictionary
        few = warc.archive(records[:n])
        size = struct.unpack("<I", few[4:8])[0]
        assert few[:4] == struct.pack("<I", 0x184D2A5D) and size > 64 and few[8:12] in (b"WARC", bytes.fromhex("37a430ec"))
        assert n > 3 or few[8:12] == b"WARC"
        assert [b.partition(b"\r\n\r\n")[2] for _, b in warc.read_archive(io.BytesIO(few))] == [b"p%d" % i * 300 for i in range(n)]


def test_every_archive_has_a_dictionary(spark):
    from pyarrow.fs import FileSystem
    pages = spark.range(60).selectExpr("id as page_id", "'u' as url", "concat(id, repeat(cast(rand(3) as string), 400)) as html")
    for options in ({}, {"archive_bytes": 1}, {"archive_bytes": 20_000}):
        for r in round_trip(spark, pages.repartition(9), **options).collect():
            store, at = FileSystem.from_uri(r.archive)
            with store.open_input_file(at) as f:
                assert f.read(4) == struct.pack("<I", 0x184D2A5D)


def test_names_of_stores(tmp_path):
    assert warc.store_of(f"file://{tmp_path}")[1] == str(tmp_path)
    assert [warc.uri_of(p) for p in ("s3a://b/a", "s3n://b/a", "s3://b/a", "hdfs://n:1/a", "/a/b")] == [
        "s3://b/a", "s3://b/a", "s3://b/a", "hdfs://n:1/a", "/a/b"]


def test_damage_is_noticed(spark):
    r = warc.record(1, "u", hashlib.sha1(b"other").hexdigest(), 5, "response", None, b"wrong", "0", warc.DATE)
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(zstandard.ZstdCompressor().compress(r[:-2] + b"xx"))))


def test_archives_of_long_records_have_a_dictionary():
    import random
    rng = random.Random(1)
    common = [" ".join(f"<p class={rng.random()}>" for _ in range(30)) for _ in range(20)]
    page = lambda n: "".join(rng.choice(common) + str(rng.random()) for _ in range(n)).encode()
    for records in ([page(180) for _ in range(256)], [page(250) for _ in range(16)]):
        assert warc.train(records) is not None
        data = warc.archive(records)
        assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
