"""WARC archives through a table of chunk rows.

A payload leaves the JVM as rows (record, chunk number, bytes) of at most 64 KiB. The
writing task streams them into gzip members of a .warc.gz file, a member a record, while a
running SHA-1 is carried from chunk to chunk; its value after every chunk is kept in the
chunk table next to the chunk's place, and the last one must be the digest that the
record's header announced. Python holds no whole record on either side; the JVM holds the
one payload that it read as a column value, and cuts a chunk of it a row.

Which record is the response of equal payloads is settled on narrow rows (id, digest,
length), aggregated in the map tasks first. Pages that a filter reports as revisits are
shuffled without their payload, which a revisit does not write; the few that are reported
falsely take theirs along. All others go straight to their file.

Reading parses the files as a stream of blocks, one task a file; files are closed at
``file_bytes`` so that there are enough of them. A revisit has no payload of its own, so
its length and digest are taken from the response it refers to.

Defined cases: a null payload is empty; a null url gives a record without a target; a null
id is smaller than any other; rows that repeat id and payload are the same record twice,
response or revisit alike; with no pages there are no files; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import mapped, rows_of, stored, work_path
from .files import attempt_name, opened

CHUNK = 1 << 16
FILE_BYTES = 1 << 26
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "file string, record_at long, page_id long, chunk_no int, payload_at long, size int, prefix_sha1 binary"
RECORDS = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    text = record_id.strip("<>").rpartition(":")[2]
    return None if text == "none" else int(text)


def _header(page_id, url: str | None, kind: str, refers_to, digest: bytes, size: int) -> bytes:
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url))
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{base32(digest)}", f"Content-Length: {len(body) + (size if kind == 'response' else 0)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body


def _archived(root: str, file_bytes: int):
    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = opened(root)
        files.create_dir(folder)
        sink = name = member = None
        number = at = 0

        def put(data: bytes) -> None:
            nonlocal at
            sink.write(data)
            at += len(data)

        for batch in batches:
            out = []
            for page_id, url, kind, refers_to, sha, size, chunk_no, last, data in rows_of(iter([batch]), 16):
                if chunk_no == 0:
                    if sink is None or at >= file_bytes:
                        if sink:
                            sink.close()
                        name, at = attempt_name("warc.gz", number), 0
                        sink = files.open_output_stream(f"{folder}/{name}", compression=None)
                        number += 1
                    begun, member, running, done = at, zlib.compressobj(1, zlib.DEFLATED, 31), hashlib.sha1(), 0
                    put(member.compress(_header(page_id, url, kind, refers_to, sha, size)))
                if kind == "response":
                    put(member.compress(data))
                    running.update(data)
                    out.append((name, begun, page_id, chunk_no, done, len(data), running.copy().digest()))
                    done += len(data)
                else:
                    out.append((name, begun, page_id, chunk_no, 0, 0, sha))
                if last:
                    if kind == "response" and running.digest() != sha:
                        raise ValueError(f"page {page_id}: the payload does not have its digest")
                    put(member.compress(b"\r\n\r\n") + member.flush())
            if out:
                types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [c.split()[0] for c in CHUNKS.split(", ")])
        if sink:
            sink.close()

    return archive


def settled(pages: DataFrame) -> DataFrame:
    """Of (page_id, url, html): page_id, url, payload, sha, size, record_type, refers_to."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    whole = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    whole = whole.withColumn("sha", F.unhex(F.sha1("payload"))).withColumn("size", F.octet_length("payload").cast("long"))
    narrow = stored(whole.select("page_id", "sha"), "warc-digests")
    groups = narrow.groupBy(F.col("sha").alias("group_sha")).agg(F.max("page_id").alias("keeper"), F.min("page_id").alias("least"), F.count("page_id").alias("n"), F.count(F.lit(1)).alias("rows"))
    groups = stored(groups.where("keeper is not null and (least <> keeper or n < rows)").select("group_sha", "keeper"), "warc-groups")
    again = narrow.join(groups, F.col("sha") == F.col("group_sha")).where("page_id is null or page_id <> keeper")
    again = stored(again.select(F.col("page_id").alias("again_id"), F.col("sha").alias("again_sha"), "keeper").distinct(), "warc-revisits")
    sent = bloom.build(again.select(F.xxhash64("again_id", "again_sha").alias("k")), bloom.slots_for(again.count()), repeats=False)
    key = F.xxhash64("page_id", "sha")
    told = narrow.where(bloom.reported(key, sent)).join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("sha") == F.col("again_sha")), "left_anti")
    told = stored(told.distinct(), "warc-reported")  # reported, but responses
    kept = bloom.build(told.select(key.alias("k")), bloom.slots_for(told.count()), repeats=False)
    marked = whole.withColumn("again", bloom.reported(key, sent))
    # A revisit has no payload of its own: only rows that may be responses take theirs along.
    marked = marked.withColumn("payload", F.when(F.col("again") & ~bloom.reported(key, kept), F.lit(None)).otherwise(F.col("payload")))
    fresh = marked.where("not again").withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast("long")})
    same = F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("sha") == F.col("again_sha"))
    met = marked.where("again").join(again, same, "left").withColumns({"record_type": F.when(F.col("again_sha").isNull(), "response").otherwise("revisit"), "refers_to": F.col("keeper")})
    columns = ["page_id", "url", "payload", "sha", "size", "record_type", "refers_to"]
    return fresh.select(columns).unionByName(met.select(columns))


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None, chunk: int = CHUNK, file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Writes the archives; gives their folder and the chunk table.

    Chunk table: file, record_at (of the gzip member), page_id, chunk_no, payload_at, size,
    prefix_sha1 (of the payload up to and with this chunk).
    """
    root = folder or work_path(pages.sparkSession, "warc")
    rows = settled(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")))
    stop = F.when(F.col("record_type") == "revisit", F.lit(0)).otherwise(F.floor(F.greatest(F.col("size") - 1, F.lit(0)) / chunk)).cast("int")
    numbered = rows.withColumn("stop", stop).select("*", F.explode(F.sequence(F.lit(0), "stop")).alias("chunk_no"))
    data = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.expr(f"substring(payload, chunk_no * {chunk} + 1, {chunk})"))
    cut = numbered.select("page_id", "url", "record_type", "refers_to", "sha", "size", "chunk_no", (F.col("chunk_no") == F.col("stop")).alias("last"), data.alias("data"))
    return root, stored(mapped(cut, _archived(root, file_bytes), CHUNKS), "warc-chunks")


class _Stream:
    """Bytes of a .warc.gz file, member after member, in blocks."""

    def __init__(self, source):
        self.source, self.unzip, self.raw, self.held = source, zlib.decompressobj(31), b"", bytearray()

    def _more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.source.read(CHUNK)
                if not self.raw:
                    return False
            if self.unzip.eof:
                self.unzip = zlib.decompressobj(31)
            data = self.unzip.decompress(self.raw, CHUNK)
            self.raw = self.unzip.unconsumed_tail or self.unzip.unused_data
            if data:
                self.held += data
                return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before ``mark``, which is passed over; None at the end of the file."""
        while (at := self.held.find(mark)) < 0:
            if not self._more():
                if self.held:
                    raise ValueError("the archive ends within a record")
                return None
        out = bytes(self.held[:at])
        del self.held[: at + len(mark)]
        return out

    def blocks(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.held and not self._more():
                raise ValueError("the archive ends within a record")
            part = bytes(self.held[: min(size, CHUNK)])
            del self.held[: len(part)]
            size -= len(part)
            yield part


def records(source) -> Iterator[tuple]:
    """(page id, type, page id referred to, payload bytes, payload digest) of every record of a file.

    For a revisit the bytes are those of its own, empty, payload and the digest is the announced one.
    """
    stream = _Stream(source)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        first, *lines = head.decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        http = stream.until(b"\r\n\r\n")
        left = int(fields["content-length"]) - len(http) - 4
        running, size = hashlib.sha1(), 0
        for part in stream.blocks(left):
            running.update(part)
            size += len(part)
        if stream.until(b"\r\n\r\n") != b"":
            raise ValueError("a record is longer than its length")
        said, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
        if kind == "response" and base32(running.digest()) != said:
            raise ValueError(f"{fields['warc-record-id']}: the payload does not have its digest")
        refers_to = fields.get("warc-refers-to")
        yield _page_of(fields["warc-record-id"]), kind, None if refers_to is None else _page_of(refers_to), size, said


def _parsed(root: str):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = opened(root)
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        table = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [c.split()[0] for c in RECORDS.split(", ")])
        for (name,) in rows_of(batches):
            out = []
            with files.open_input_file(f"{folder}/{name}") as source:
                for record in records(source):
                    out.append(record)
                    if len(out) == 4096:
                        yield table(out)
                        out = []
            if out:
                yield table(out)

    return parse


def read(root: str, chunks: DataFrame) -> DataFrame:
    """Per record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = chunks.sparkSession
    names = chunks.select("file").distinct().repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = stored(mapped(names, _parsed(root), RECORDS), "warc-records")
    own = found.where("record_type = 'response'")
    targets = own.select(F.col("page_id").alias("target"), F.col("payload_digest").alias("target_digest"), F.col("payload_bytes").alias("target_bytes")).distinct()
    again = found.where("record_type = 'revisit'").drop("payload_bytes")
    named = stored(targets.join(again.select(F.col("refers_to").alias("target"), F.col("payload_digest").alias("target_digest")).distinct(), ["target", "target_digest"], "left_semi"), "warc-targets")
    same = (F.col("refers_to") == F.col("target")) & (F.col("payload_digest") == F.col("target_digest"))
    met = again.join(named, same, "left").select("page_id", F.col("target_bytes").alias("payload_bytes"), F.col("target_digest").alias("payload_digest"), "record_type", "refers_to")
    return own.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").unionByName(met)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the archives and reads them back."""
    return read(*write(pages))
