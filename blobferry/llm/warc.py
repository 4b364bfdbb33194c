"""WARC archives written and read through an index.

Writing gives one index row per record first: archive, offset, length, URL and
payload digest. Reading takes any selection of index rows, sorts it by archive
and offset, and merges neighbouring byte ranges into few large reads.

Records are gzip members of their own (``.warc.gz``), so a byte range is
readable alone. Of the records with equal payloads of at least
``MIN_REVISIT`` bytes the one with the smallest id is a ``response``, the
others are ``revisit`` records without the payload. Only digests and ids are
compared to decide that, never payloads collected in one place.
"""

from __future__ import annotations

import gzip
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, functions as F, types as T

from blobferry.llm.common import materialize, scratch_path
from blobferry.sources.objectstore import open_fs

MIN_REVISIT = 100
ROLL_BYTES = 256 << 20   # a task starts a new archive beyond this size
GAP_BYTES = 64 << 10     # ranges closer than this are read as one
READ_BYTES = 8 << 20     # largest merged read, one record at least
TASK_BYTES = 64 << 20    # archive bytes that one task reads, about
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

INDEX = T.StructType([T.StructField(n, t) for n, t in (
    ("archive", T.StringType()), ("offset", T.LongType()), ("length", T.LongType()), ("page_id", T.LongType()),
    ("url", T.StringType()), ("payload_digest", T.StringType()), ("payload_bytes", T.LongType()),
    ("record_type", T.StringType()), ("refers_to", T.LongType()))])
RECORDS = T.StructType([T.StructField(n, t) for n, t in (
    ("page_id", T.LongType()), ("url", T.StringType()), ("record_type", T.StringType()),
    ("refers_to", T.LongType()), ("payload_bytes", T.LongType()), ("declared_digest", T.StringType()),
    ("payload", T.BinaryType()))])


def record(page_id, url, payload: bytes, digest: str, n: int, refers_to) -> bytes:
    """One uncompressed record; a revisit holds no payload but its length and digest."""
    if refers_to is None:
        kind, block = "response", HTTP % n + payload
    else:
        kind, block = "revisit", HTTP % n
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
            "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {n}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:  # control characters would end the line, so they are percent-encoded
        head.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127))).replace("%", "") + "%"))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes):
    """``(headers, payload)`` of one record; the payload is what follows the HTTP head."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _write(batches, out_dir: str):
    import pyarrow as pa

    fs, base = open_fs(out_dir)
    f, name, at = None, "", 0
    for batch in batches:
        rows = []
        for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
            if f is None:
                fs.create_dir(base, recursive=True)
                name, at = f"{out_dir}/{uuid.uuid4().hex}.warc.gz", 0
                f = fs.open_output_stream(f"{base}/{name.rpartition('/')[2]}", compression=None)
            z = gzip.compress(record(page_id, url, payload, digest, len(payload), refers_to), 1, mtime=0)
            f.write(z)
            rows.append((name, at, len(z), page_id, url, digest, len(payload),
                         "response" if refers_to is None else "revisit", refers_to))
            at += len(z)
            if at >= ROLL_BYTES:
                f.close()
                f = None
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                    pa.string(), pa.int64()))], names=INDEX.names)
    if f is not None:
        f.close()


def write_archives(pages: DataFrame, out_dir: str, id_col="page_id", url_col="url", payload_col="html") -> DataFrame:
    """Write one record per row below ``out_dir`` (a shared folder) and return the written index.

    Null payload: empty. Null URL: no target line. A null id is written and
    read back as null; as it cannot be referred to, such rows are responses and
    no revisit points at them. Rows that repeat the smallest id of a payload
    are responses as well. Archives of lost attempts are in no index row.
    """
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                       F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    src = src.withColumn("digest", F.sha2("payload", 256))
    long_ = F.octet_length("payload") >= MIN_REVISIT
    # summed in the tasks before the shuffle, so a payload that a third of all rows share is no hot key here
    firsts = materialize(src.where(long_ & F.col("page_id").isNotNull()).groupBy("digest")
                         .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
                         .where("first < last").select("digest", "first"), "first-holders")
    # joined with payloads: written first, so both sides are plain shuffles and Spark splits a hot digest
    joined = src.join(firsts, "digest", "left")
    refers = F.when(F.col("page_id") > F.col("first"), F.col("first"))
    rows = joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))
    return materialize(rows.mapInArrow(lambda b: _write(b, out_dir), INDEX), "warc-index")


def _read(batches):
    import pyarrow as pa

    def emit(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
            names=RECORDS.names)

    def fetch(ranges):
        """Merged ranges of one archive: (offset, length) of each record, in order."""
        lo = ranges[0][1]
        hi = max(o + n for _, o, n in ranges)
        raw = file.read_at(hi - lo, lo)
        for _, o, n in ranges:
            h, payload = parse(gzip.decompress(raw[o - lo:o - lo + n]))
            ref, pid = h.get("X-Refers-To-Page-ID"), h.get("X-Page-ID")
            url = h.get("WARC-Target-URI")
            yield (None if pid is None else int(pid), url, h["WARC-Type"], None if ref is None else int(ref),
                   int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].partition(":")[2],
                   payload if ref is None else None)

    name, file = None, None
    for batch in batches:
        todo = list(zip(*(c.to_pylist() for c in batch.columns)))
        i = 0
        while i < len(todo):
            if todo[i][0] != name:
                name = todo[i][0]
                folder, _, base = name.rpartition("/")
                fs, root = open_fs(folder)
                file = fs.open_input_file(f"{root}/{base}")
            j, end = i + 1, todo[i][1] + todo[i][2]
            while (j < len(todo) and todo[j][0] == name and todo[j][1] - end <= GAP_BYTES
                   and todo[j][1] + todo[j][2] - todo[i][1] <= READ_BYTES):
                end = max(end, todo[j][1] + todo[j][2])
                j += 1
            yield emit(list(fetch(todo[i:j])))
            i = j


def read_archives(selected: DataFrame) -> DataFrame:
    """Records of the selected index rows (``archive, offset, length``): sorted by
    range, so that each task reads a stretch of few archives in large merged reads.
    Tasks are sized by the bytes they fetch, not by the size of their index rows."""
    total = selected.agg(F.sum("length")).first()[0] or 0
    rows = selected.select("archive", "offset", "length") \
        .repartitionByRange(max(1, -(-total // TASK_BYTES)), "archive", "offset") \
        .sortWithinPartitions("archive", "offset")
    return rows.mapInArrow(_read, RECORDS)


def archive_pages(pages: DataFrame, out_dir: str | None = None) -> DataFrame:
    """Write all pages, read all records back; the digest of a response is that of
    the payload as read, that of a revisit is the one its record declares.
    An empty table gives no archive and no row."""
    out_dir = out_dir or scratch_path(pages.sparkSession, "warc")
    back = read_archives(write_archives(pages, out_dir))
    response = F.col("record_type") == "response"
    return back.select(
        "page_id", "url", "record_type", "refers_to",
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.col("declared_digest")).alias("payload_digest"))
