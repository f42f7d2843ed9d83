"""Dictionary-compressed WARC writer and reader.

Every page becomes a WARC/1.1 record in a ``.warc.zst`` archive: a leading skippable frame
holds a Zstandard dictionary made of records of that archive (trained, or, where records are
too few or too alike to train on, their raw content), then each record is a frame of its own. Equal payloads of at least ``min_revisit`` bytes are stored once: the
record with the largest page_id is the response, the others are revisits that refer to it.

Tasks write archives to the shared folder; the manifest is a table written by Spark, so
archives of a failed or repeated attempt are never read. Reading streams one record at a time.

Defined results: a null html is an empty payload; payloads under the bound are all
responses; null page ids are smaller than all others and read back as null; of rows equal in
page id and payload that tie for the response, the largest url (then any one of wholly equal
rows) is it and the others revisit that page_id; an empty table gives no archive and an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import base64
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import broadcast_if_small, materialise, pick

MIN_REVISIT = 1000
ARCHIVE_BYTES = 32 << 20     # uncompressed records of one archive
DICT_BYTES = 64 << 10
SAMPLE_BYTES = 1 << 20       # records a dictionary is trained on, spread evenly over the archive
LEAST_SAMPLES = 100          # or all records, if fewer
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
SKIPPABLE = 0x184D2A5D       # fixed value: magic of the dictionary frame
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id, url, digest: str, size: int, kind: str, refers_to, payload: bytes, place: str, date: str) -> bytes:
    """The bytes of one record; a revisit carries the HTTP header only."""
    name = "" if page_id is None else page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {date}",
            f"WARC-Record-ID: <urn:page:{name}:{digest}{'' if kind == 'response' else ':revisit:' + place}>",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}",
                 f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}:{digest}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(records: list[bytes], dict_bytes: int = DICT_BYTES, sample_bytes: int = SAMPLE_BYTES):
    """A dictionary from evenly spaced records.

    At least ``LEAST_SAMPLES`` records are taken; when they are too long together, only a part
    of each (its head or, in turn, a later place) is trained on. Where the trainer refuses (few
    records, or nothing that recurs), the same parts stand in the dictionary as they are.
    """
    import zstandard

    total = sum(map(len, records))
    take = min(len(records), max(LEAST_SAMPLES, sample_bytes * len(records) // max(1, total)))
    sample = [records[i * len(records) // take] for i in range(take)]
    if sum(map(len, sample)) > sample_bytes:
        most = sample_bytes // take
        at = [i % 2 * max(0, len(r) - most) * i // take for i, r in enumerate(sample)]
        sample = [r[a:a + most] for r, a in zip(sample, at)]
    try:
        return zstandard.train_dictionary(min(dict_bytes, max(4096, total // 20)), sample, k=256, d=8, level=LEVEL)
    except zstandard.ZstdError:
        few = sample[:: -(-len(sample) // 16)]
        raw = b"".join(r[:max(64, min(dict_bytes, max(1024, total // 4)) // len(few))] for r in few)
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes]) -> bytes:
    import zstandard

    dictionary = train(records)
    out = io.BytesIO()
    raw = dictionary.as_bytes()
    out.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
    dictionary.precompute_compress(level=LEVEL)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    for r in records:
        out.write(compressor.compress(r))
    return out.getvalue()


def read_archive(source) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of each record of an open archive, streamed."""
    import zstandard

    lead, dictionary = source.read(8), None
    if len(lead) == 8 and struct.unpack("<I", lead[:4])[0] == SKIPPABLE:
        dictionary = zstandard.ZstdCompressionDict(source.read(struct.unpack("<I", lead[4:])[0]))
    else:
        source.seek(0)
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(
        source, read_across_frames=True), 1 << 18)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no record where one should begin: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) != b"\r\n":
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[key] = value
        block = stream.read(int(fields["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields, block


def roles(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``(page_id, url, html, digest, size, record_type, refers_to)`` of every page.

    Payloads are compared by SHA-1 and length in a narrow aggregate with map-side combine;
    only repeated digests are joined back (a written table: broadcast when small, else a
    join whose hot digest can be split). A revisit's html is dropped.
    """
    pages = pick(pages, "page_id", "url", "html")
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint"), "url", html.alias("html"), F.sha1(html).alias("digest"),
                        F.octet_length(html).cast("bigint").alias("size"))
    large = rows.where(F.col("size") >= min_revisit)
    last = F.struct("page_id", "url")
    repeated = materialise(
        large.groupBy("digest", "page_id", "url").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("digest").agg(F.max(last).alias("keep"), F.max_by("n", last).alias("ties"), F.sum("n").alias("n"))
        .where("n > 1").select(F.col("digest").alias("d"), "keep", "ties"), "warc-repeated")
    found = rows.join(broadcast_if_small(repeated, 200),
                      (F.col("digest") == F.col("d")) & (F.col("size") >= min_revisit), "left")
    mine = F.col("page_id").eqNullSafe(F.col("keep.page_id")) & F.col("url").eqNullSafe(F.col("keep.url"))
    response = F.col("d").isNull() | mine
    out = found.withColumn("record_type", F.when(response, "response").otherwise("revisit")).select(
        "page_id", "url", F.when(response, F.col("html")).alias("html"), "digest", "size", "record_type",
        F.when(~response, F.col("keep.page_id")).alias("refers_to"),
        (mine & (F.col("ties") > 1)).alias("tied"))
    if repeated.where("ties > 1").isEmpty():
        return out.drop("tied")
    # wholly equal rows tie for the response: one of them is it, the others revisit it
    one = (out.where("tied").groupBy("page_id", "url", "digest", "size")
           .agg(F.first("html").alias("html"), F.count(F.lit(1)).alias("n"))
           .select("*", F.explode(F.expr("sequence(1, cast(n as int))")).alias("i"))
           .select("page_id", "url", F.when(F.col("i") == 1, F.col("html")).alias("html"), "digest", "size",
                   F.when(F.col("i") == 1, "response").otherwise("revisit").alias("record_type"),
                   F.when(F.col("i") > 1, F.col("page_id")).alias("refers_to")))
    return out.where("not coalesce(tied, false)").drop("tied").unionByName(one)


def uri_of(path: str) -> str:
    """``path`` under the name that Arrow has for its file system: Hadoop calls S3 s3a or s3n."""
    scheme, mark, rest = path.partition("://")
    return f"s3://{rest}" if mark and scheme in ("s3a", "s3n") else path


def store_of(path: str):
    """The file system of a folder or file, and its path there."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri_of(path))


def write(pages: DataFrame, folder: str | None = None, min_revisit: int = MIN_REVISIT,
          archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Write every page; returns the manifest ``(archive, records, bytes, raw_bytes)``."""
    folder = folder or scratch_path(pages.sparkSession, "warc")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        store, root = store_of(folder)
        store.create_dir(root, recursive=True)
        task, pending, size, count = TaskContext.get().partitionId(), [], 0, 0
        attempt = uuid.uuid4().hex[:8]

        def flush():
            nonlocal pending, size, count
            name = f"part-{task:05d}-{attempt}-{count:04d}.warc.zst"
            data = archive(pending)
            with store.open_output_stream(f"{root}/{name}", compression=None) as f:
                f.write(data)
            row = pa.RecordBatch.from_pydict({"archive": [name], "records": [len(pending)], "bytes": [len(data)],
                                              "raw_bytes": [size]})
            pending, size, count = [], 0, count + 1
            return row

        n = 0
        for b in batches:
            columns = [b.column(b.schema.get_field_index(c)) for c in
                       ("page_id", "url", "digest", "size", "record_type", "refers_to", "html")]
            for i in range(b.num_rows):
                page, url, digest, length, kind, refers, html = (c[i].as_py() for c in columns)
                r = record(page, url, digest, length, kind, refers, html or b"", f"{task}-{n}", date)
                n += 1
                pending.append(r)
                size += len(r)
                if size >= archive_bytes:
                    yield flush()
        if pending:
            yield flush()

    rows = roles(pages, min_revisit).withColumn("html", F.col("html").cast("binary"))
    made = rows.mapInArrow(run, "archive string, records bigint, bytes bigint, raw_bytes bigint")
    return materialise(made, "warc-manifest").withColumn("archive", F.concat(F.lit(folder + "/"), "archive"))


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """A row per record of the archives named in ``manifest``; digests of stored payloads are checked."""
    def run(batches):
        import hashlib

        import pyarrow as pa

        def flush(rows):
            cols = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              names=["page_id", "payload_bytes", "payload_digest", "record_type",
                                                     "refers_to", "archive"])

        number = lambda s: int(s) if s else None
        for b in batches:
            for path in b.column(0).to_pylist():
                store, at = store_of(path)
                rows = []
                with store.open_input_file(at) as f:
                    for fields, block in read_archive(f):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        size = int(head.rpartition(b"Content-Length: ")[2])
                        digest = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
                        kind, refers = fields["WARC-Type"], None
                        if kind == "response":
                            if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
                                raise ValueError(f"damaged payload in {path}: {fields['WARC-Record-ID']}")
                        else:
                            refers = number(fields["WARC-Refers-To"].split(":")[2])
                        rows.append((number(fields["WARC-Record-ID"].split(":")[2]), size, digest, kind, refers, path))
                        if len(rows) >= 10_000:
                            yield flush(rows)
                            rows = []
                yield flush(rows)

    paths = manifest.select("archive")
    tasks = max(1, min(paths.count(), 4 * spark.sparkContext.defaultParallelism))
    return paths.repartition(tasks).mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, archive string")
