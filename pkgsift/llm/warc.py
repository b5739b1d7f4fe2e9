"""Deterministic sharded WARC archives (operator 7).

Records are range-sorted by page id into shards whose limits depend on the rows
alone.  A task writes its shard's records one by one, each its own gzip member,
and rolls to the next file by compressed size.  Headers, record ids and digests
are made anew from the payload.  A file is written under a temporary name and
renamed; the manifest is a Spark table whose commit marks the archive complete,
so a retried task writes the same files again.

The duplicate table is narrow (page id and digest).  Pages cross the network
once: the rows that say "this page revisits that one" travel in the same sort
and stand right before their page.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pkgsift.llm.common import bounded_batches, commit, filesystem, shard_column, table

#: Payload bytes of a shard, and compressed bytes at which a file is full.
SHARD_BYTES = 48 << 20
ROLL_BYTES = 16 << 20
#: Fixed: profile of a revisit with an equal payload, by the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{payload_digest}')}>"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record: a response, or a revisit of page ``refers_to``."""
    revisit = refers_to is not None
    own = digest(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page, own + "/revisit" * revisit)), ("WARC-Date", date)]
    if url is not None:  # line ends and blanks may not stand in a header value
        head.append(("WARC-Target-URI", re.sub(r"[\s%]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, own)), ("Refers-To-Page", str(refers_to))]
    if page is not None:
        head.append(("Page", str(page)))
    head += [("Payload-Length", str(len(payload))), ("WARC-Payload-Digest", f"sha1:{own}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
             ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head), "\r\n"]).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record; raises if a digest does not hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != f"sha1:{digest(block.partition(b'\r\n\r\n')[2])}":
        raise ValueError(f"damaged payload {headers['WARC-Record-ID']}")
    return headers, block


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)  # its gzip header holds no time
    return z.compress(data) + z.flush()


def members(stream) -> Iterator[bytes]:
    """The unpacked gzip members of a stream, one after another."""
    z, parts = zlib.decompressobj(31), []
    while data := stream.read(1 << 20):
        while data:
            parts.append(z.decompress(data))
            data = z.unused_data
            if z.eof:
                yield b"".join(parts)
                z, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("cut-off archive")


class _Shard:
    """Writes one shard's files; ``files`` has a manifest row for each."""

    def __init__(self, root: str, shard: int, roll: int):
        self.fs, self.root = filesystem(root)
        self.shard, self.roll, self.files, self.out = shard, roll, [], None

    def add(self, page: int | None, data: bytes) -> None:
        if self.out is None:
            self.made = f"{self.root}/_temporary/{uuid.uuid4().hex}"
            self.out, self.size, self.count, self.first = self.fs.open_output_stream(self.made, compression=None), 0, 0, page
        packed = gzip_member(data)
        self.out.write(packed)
        self.size, self.count, self.last = self.size + len(packed), self.count + 1, page
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        name = f"pages-{self.shard:06d}-{len(self.files):05d}.warc.gz"
        commit(self.fs, self.made, f"{self.root}/{name}")
        self.files.append({"file": name, "records": self.count, "bytes": self.size, "first_page": self.first, "last_page": self.last})
        self.out = None


_MANIFEST = "file string, records long, bytes long, first_page long, last_page long"


def write_warc(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write archives under ``root``; returns the manifest (file, records, bytes,
    first_page, last_page), written to ``root``/manifest.

    Of records with equal payloads of at least ``min_bytes`` bytes, the one with
    the largest page id is the response and the others revisit it; of repeated
    rows with that id the first is the response.  A null html is an empty
    payload; a null url has no target header; null ids sort first and are
    responses only if no equal payload has an id.  An empty table writes no file.
    Other columns are ignored.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("html"))
    narrow = table(rows.select("page", F.sha1("html").alias("sha"), F.octet_length("html").alias("size")), "digests")
    shard, count = shard_column(narrow, "page", F.col("size") + 256, shard_bytes)
    newest = narrow.where(F.col("size") >= min_bytes).groupBy("sha").agg(F.max("page").alias("newest"), F.count("*").alias("n")).where("n > 1")
    older = (narrow.join(newest.select("sha", "newest"), "sha").where("newest is not null")
             .select("page", "sha", "newest").distinct())
    none = F.lit(None)
    both = (older.select("page", F.lit(0).alias("kind"), "sha", "newest", none.cast("string").alias("url"), none.cast("binary").alias("html"))
            .unionByName(rows.select("page", F.lit(1).alias("kind"), none.cast("string").alias("sha"), none.cast("long").alias("newest"), "url", "html")))
    fs, at = filesystem(root)
    fs.create_dir(f"{at}/_temporary", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, page, known, done = None, None, object(), {}, set()
        for batch in batches:
            for s, p, kind, sha, newest, url, html in zip(*(batch.column(k).to_pylist() for k in range(7))):
                if s != now:
                    if out:
                        out.close()
                        yield pa.RecordBatch.from_pylist(out.files, schema)
                    out, now, page = _Shard(root, s, roll_bytes), s, object()
                if p != page:
                    page, known, done = p, {}, set()
                if kind == 0:
                    known[sha] = newest
                    continue
                own = hashlib.sha1(html).hexdigest()
                target = known.get(own)
                if target == p and own not in done:
                    target = None
                done.add(own)
                out.add(p, record(p, url, html, target))
        if out:
            out.close()
            yield pa.RecordBatch.from_pylist(out.files, schema)

    schema = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("first_page", pa.int64()), ("last_page", pa.int64())])
    dealt = both.withColumn("shard", shard).select("shard", "page", "kind", "sha", "newest", "url", "html")
    manifest = (dealt.repartitionById(count, F.col("shard")).sortWithinPartitions("shard", "page", "kind", "sha", "url", "html").mapInArrow(run, _MANIFEST))
    manifest.write.parquet(f"{root}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")


def read_warc(manifest: DataFrame, root: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of every
    record of the listed files, digests checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = filesystem(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with fs.open_input_stream(f"{at}/{name}", compression=None) as f:
                    for data in members(f):
                        h, _ = parse(data)
                        rows.append({
                            "page_id": int(h["Page"]) if "Page" in h else None, "url": h.get("WARC-Target-URI"),
                            "payload_bytes": int(h["Payload-Length"]), "payload_digest": h["WARC-Payload-Digest"].removeprefix("sha1:"),
                            "record_type": h["WARC-Type"], "refers_to": int(h["Refers-To-Page"]) if "Refers-To-Page" in h else None})
                yield pa.RecordBatch.from_pylist(rows, pa.schema([
                    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64())]))

    spark = manifest.sparkSession
    width = 4 * max(1, min(manifest.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return manifest.select("file").repartition(width, "file").mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")
