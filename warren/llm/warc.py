"""WARC archives: written and read by Spark's own files, with repeated payloads resolved to revisit records."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warren.llm.common import checkpointed

#: Payloads below this many bytes are always stored.
LEAST_BYTES = 100
#: Records in an archive file, which readers hold whole, and the bytes of payload that bound it.
RECORDS_A_FILE, BYTES_A_FILE = 2000, 128 << 20
#: The end of a line and of a record.
CRLF = "\r\n"
RECORD_END = "\r\n\r\n"


def payloads(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest); null html is an empty payload."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload.cast("binary"), 256).alias("payload_digest"))


def resolve_revisits(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the records that revisit another: same payload, a smaller page_id.

    Only headers (page_id, digest, size) are shuffled. Copies are pre-aggregated to the smallest id of each
    digest, and the join back leaves hot digests to AQE's skew handling.
    """
    heads = records.filter(F.col("payload_bytes") >= least_bytes).select("page_id", "payload_digest")
    first = heads.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return heads.join(first, "payload_digest").filter("page_id > refers_to").select("page_id", "payload_digest", "refers_to").distinct()


def as_records(records: DataFrame, revisits: DataFrame, written: str) -> DataFrame:
    """One column `value`: each record's fresh header (dated `written`) and payload as text, without its end."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    url = F.regexp_replace("url", r"[\r\n]", "")
    head = lambda kind, *more: F.concat(F.lit("WARC/1.1\r\n"), line("WARC-Type", F.lit(kind)), line("WARC-Record-ID", name("page_id")), line("WARC-Date", F.lit(written)), line("WARC-Target-URI", url), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")), line("Content-Type", F.lit("text/html")), *more)
    stored = F.concat(head("response", line("Content-Length", F.col("payload_bytes").cast("string"))), F.lit(CRLF), "payload")
    revisit = F.concat(head("revisit", line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", name("refers_to")), line("Content-Length", F.lit("0"))), F.lit(CRLF))
    joined = records.join(revisits, ["page_id", "payload_digest"], "left")
    return joined.select(F.when(F.col("refers_to").isNull(), stored).otherwise(revisit).alias("value"))


def write_warc(values: DataFrame, path: str, records_a_file: int = RECORDS_A_FILE) -> None:
    """Adds gzip archives under `path`, any store Spark writes to: a record's end is the text writer's line end."""
    values.write.mode("append").option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", records_a_file).text(path)


#: A class of payloads has at most so many times the bytes of the class below it, so its files are a quarter full at least.
CLASS_RATIO = 4


def size_classes(bytes_a_file: int) -> list[tuple[int, int]]:
    """(largest payload, records a file) of each class: the first by the number of records, the last with a record a file."""
    out, top = [], bytes_a_file // RECORDS_A_FILE
    while top < bytes_a_file:
        out.append((top, bytes_a_file // top))
        top *= CLASS_RATIO
    return [*out, (1 << 62, 1)]


def write_archives(records: DataFrame, revisits: DataFrame, path: str, bytes_a_file: int | None = None) -> None:
    """Writes all records, so that no file holds more than `bytes_a_file` (BYTES_A_FILE) of payload unless one record alone does.

    Payloads are written by class of size, each with as many records a file as its largest size allows. So a class's
    files are a quarter full but for the last of each task, and their number goes with the bytes, whatever the largest
    payload. One more pass over the sizes finds the classes that there are.
    """
    written, classes = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), size_classes(bytes_a_file or BYTES_A_FILE)
    of = F.lit(len(classes) - 1)
    for k in range(len(classes) - 2, -1, -1):
        of = F.when(F.col("payload_bytes") <= classes[k][0], k).otherwise(of)
    there = records.agg(F.collect_set(of)).first()[0]  # at most one number for each class
    for k in sorted(there) or [0]:
        low, (high, many) = classes[k - 1][0] if k else -1, classes[k]
        write_warc(as_records(records.filter((F.col("payload_bytes") > low) & (F.col("payload_bytes") <= high)), revisits, written), path, many)


class _Inflated:
    """Reads the bytes of a gzip file's members, a megabyte or so at a time."""

    def __init__(self, data: bytes):
        self.raw, self.at, self.member, self.held, self.begin = memoryview(data), 0, zlib.decompressobj(31), b"", 0

    def _more(self) -> bool:
        if self.member.eof:
            self.at -= len(self.member.unused_data)
            self.member = zlib.decompressobj(31)
        part = self.raw[self.at : self.at + (1 << 18)]
        self.at += len(part)
        self.held, self.begin = self.held[self.begin :] + self.member.decompress(part), 0
        return bool(part)

    def until(self, mark: bytes) -> bytes | None:
        """What precedes the mark, which is passed over; None at the end."""
        while (stop := self.held.find(mark, self.begin)) < 0:
            if not self._more():
                if len(self.held) > self.begin:
                    raise ValueError("an archive ends within a record")
                return None
        out, self.begin = self.held[self.begin : stop], stop + len(mark)
        return out

    def take(self, n: int) -> bytes:
        if len(self.held) - self.begin < n:
            parts, size = [self.held[self.begin :]], len(self.held) - self.begin
            self.held, self.begin = b"", 0
            while size < n and self._more():
                parts.append(self.held)
                size += len(self.held)
                self.held = b""
            self.held = b"".join(parts)
        out, self.begin = self.held[self.begin : self.begin + n], self.begin + n
        return out


def _parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records (header fields, payload) of a compressed archive, one at a time."""
    source, end = _Inflated(data), RECORD_END.encode()
    while (head := source.until(end)) is not None:
        first, *lines = head.decode().split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError("no WARC record where one should begin")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
        payload = source.take(int(fields["Content-Length"]))
        if source.take(len(end)) != end:
            raise ValueError("a record ends elsewhere than its Content-Length says")
        yield fields, payload


RECORD = "page_id bigint, url string, record_type string, header_digest string, refers_to bigint, payload binary"


def read_warc(df_reader, path: str) -> DataFrame:
    """The records of the archives under `path` as rows; `df_reader` is spark.read.

    One file is one task's row, of at most BYTES_A_FILE before compression; its records are inflated and passed on
    a few at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: None if x in (None, "<urn:page:null>") else int(x[10:-1])
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        rows, size = [], 0

        def flushed() -> pa.RecordBatch:
            nonlocal size
            made = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in RECORD.split(", ")])
            rows.clear()
            size = 0
            return made

        for batch in batches:
            for content in batch.column("content"):
                for h, p in _parse(content.as_buffer()):
                    rows.append((number(h["WARC-Record-ID"]), h["WARC-Target-URI"], h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha256:"), number(h.get("WARC-Refers-To")), p))
                    size += len(p)
                    if len(rows) >= 500 or size >= 8 << 20:
                        yield flushed()
        if rows:
            yield flushed()

    return df_reader.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def archived(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes deduplicated archives of `pages` under `path`, reads them back and resolves the revisits.

    Gives page_id, payload_bytes, payload_digest (from the payload as read, for revisits that of the response),
    record_type, refers_to and url.

    Defined results: null html is an empty payload; rows with a null page_id are responses and nothing refers to
    them; rows that repeat the smallest page_id of a payload (ties) are each stored; a payload beyond the file bound
    is a file of its own, at most 2 GB; an empty table gives no rows; other columns are not read.
    """
    records = payloads(pages)
    write_archives(records, resolve_revisits(records, least_bytes), path)
    read = read_warc(pages.sparkSession.read, path)
    digest = F.sha2("payload", 256)
    checked = F.when((F.col("record_type") == "response") & (digest != F.col("header_digest")), F.raise_error(F.lit("a payload differs from its digest"))).otherwise(digest)
    heads = checkpointed(read.select("page_id", "url", "record_type", "refers_to", "header_digest", F.octet_length("payload").cast("long").alias("payload_bytes"), checked.cast("string").alias("payload_digest")))
    responses, revisits = heads.filter("record_type = 'response'").drop("header_digest"), heads.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    meant = revisits.select("refers_to", "header_digest").distinct()
    sizes = responses.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("header_digest"), "payload_bytes", "payload_digest").distinct()
    origin = meant.join(sizes, ["refers_to", "header_digest"])
    return responses.unionByName(revisits.join(origin, ["refers_to", "header_digest"]).drop("header_digest"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS f FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > f THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > f THEN f END AS refers_to
FROM m
"""
