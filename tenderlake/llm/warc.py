"""WARC archives with resolved revisits.

Only headers (page id, payload digest, length) are shuffled to find repeated payloads: the
smallest page id of each digest is the original, the others become revisit records that
refer to it.  The archives are then written with fresh headers: WARC/1.1, a new record id and date, a response with its
HTTP block or a revisit of profile identical-payload-digest with an empty payload, which names the original's
URI and date.  Reading parses the archives record by record, checks lengths, digests what is stored, and joins
revisits to their responses to tell their payloads.

Archives are gzip files in the shared folder, written by Spark's committer and read through Spark's text
source, so any store that Spark reaches will do, lost tasks run again, and a task holds one record and a batch of
lines, however large the archive.  A file is one gzip member: Spark's codec makes no others.

Defined cases: a null html is an empty payload; a null url is an empty target; line breaks in
urls are percent-encoded; rows with a null page_id are responses to which nothing refers; rows with the
smallest page_id of a payload are all responses, even if repeated; records of equal payloads and page ids are
written each, with ids of their own; a payload of any length is one record, held whole by one task; extra columns are ignored; an empty table gives archives without records.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, frugal, table

LEAST_BYTES, PER_FILE = 100, 20_000
#: Records that are handed on at a time.
ROWS = 10_000
#: Revisits known to be no more than this are broadcast to the pages; more are joined.
BROADCAST_REVISITS, BROADCAST_BYTES = 100_000, 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL, END = "\r\n", "\r\n\r\n"
SCHEMA = "page_id long, record_type string, target string, digest string, refers_to long, payload_bytes long, stored_digest string"


def revisits_of(heads: DataFrame, scratch: Scratch, least: int = LEAST_BYTES) -> DataFrame:
    """(page_id, digest, original, original_url) of the records that repeat the payload of a smaller page id; heads is a stored table (page_id, url, digest, bytes)."""
    large = heads.where((F.col("bytes") >= least) & F.col("page_id").isNotNull())
    first = large.groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    originals = scratch.save(first.select("digest", F.col("first.page_id").alias("original"), F.col("first.url").alias("original_url")), "originals")
    return scratch.save(large.join(originals, "digest").where("page_id <> original").select("page_id", "digest", "original", "original_url").distinct(), "revisits")


def write_archives(pages: DataFrame, path: str, scratch: Scratch, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_BYTES, date: str | None = None) -> None:
    """Writes a record for each row under `path`; date is that of all records, now by default."""
    when = F.lit(date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"))
    payload = F.coalesce(F.col(html), F.lit(""))
    known = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))
    heads = scratch.save(known.select("page_id", "url", "digest", "bytes"), "heads")
    revisits = revisits_of(heads, scratch, least)
    few = revisits.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("original_url") + 150), F.lit(0))).first()
    few = few[0] <= BROADCAST_REVISITS and few[1] <= BROADCAST_BYTES
    met = known.join(F.broadcast(revisits) if few else revisits, ["page_id", "digest"], "left")

    again = F.col("original").isNotNull()
    uri = lambda c: F.replace(F.replace(c, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block_bytes = F.octet_length(http) + F.when(again, 0).otherwise(F.col("bytes"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(EOL))
    head = F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))),
        line("WARC-Date", when),
        line("WARC-Target-URI", uri("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(again, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To-Target-URI", uri("original_url")), line("WARC-Refers-To-Date", when), line("X-Refers-To-Page", F.col("original").cast("string")))).otherwise(""),
        F.when(F.col("page_id").isNotNull(), line("X-Page-Id", F.col("page_id").cast("string"))).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{EOL}"),
        line("Content-Length", block_bytes.cast("string")),
    )
    record = F.concat(head, F.lit(EOL), http, F.when(again, "").otherwise(F.col("payload")))
    met.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", PER_FILE).text(path)


class Stream:
    """Bytes in order, given in lines that END ended; the last line of a file need not have had it."""

    def __init__(self, lines: Iterable[bytes]):
        self.lines, self.held = iter(lines), bytearray()

    def _more(self) -> bool:
        line = next(self.lines, None)
        if line is None:
            return False
        self.held += line
        self.held += END.encode()
        return True

    def to_blank_line(self) -> bytes:
        """What comes before the next END, which is passed over; empty at the end of the file."""
        at = 0
        while (found := self.held.find(END.encode(), at)) < 0:
            at = max(0, len(self.held) - 3)
            if not self._more():
                return b""
        out = bytes(self.held[:found])
        del self.held[: found + 4]
        return out

    def read(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def parse(lines: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, given in what its ENDs separate; names of headers in lower case."""
    stream = Stream(lines)
    while head := stream.to_blank_line():
        first, *rest = head.decode("utf-8").split(EOL)
        if first != "WARC/1.1":
            raise ValueError("no record where one should begin")
        headers = {name.strip().lower(): value.strip(" \t") for name, _, value in (x.partition(":") for x in rest)}
        n = int(headers["content-length"])
        block = stream.read(n)
        if len(block) != n or stream.read(4) != END.encode():
            raise ValueError("a record of another length than its header says")
        yield headers, block


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row of SCHEMA for each record; of a revisit, payload_bytes and stored_digest are null."""
    kinds = pa.schema([(n, pa.int64() if k == "long" else pa.string()) for n, k in map(str.split, SCHEMA.split(", "))])

    def lines(batches) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), (x.as_buffer().to_pybytes() for x in batch.column(1)), strict=True)

    def told(batches):
        rows = []
        for _, own in itertools.groupby(lines(batches), key=lambda x: x[0]):  # gzip files aren't split: each lies in one task, in order
            for h, block in parse(x for _, x in own):
                payload = block[block.index(END.encode()) + 4 :] if h["warc-type"] == "response" else None
                number = lambda name, h=h: int(h[name]) if name in h else None
                rows.append((number("x-page-id"), h["warc-type"], h["warc-target-uri"], h["warc-payload-digest"].removeprefix("sha256:"), number("x-refers-to-page"), None if payload is None else len(payload), None if payload is None else hashlib.sha256(payload).hexdigest()))
                if len(rows) == ROWS:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)
                    rows = []
        if rows:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)

    def run(batches):
        with frugal():
            yield from told(batches)

    return spark.read.option("lineSep", END).text(path).select("_metadata.file_path", "value").mapInArrow(run, SCHEMA)


def resolve(records: DataFrame, scratch: Scratch) -> DataFrame:
    """The records with payload_bytes and payload_digest of the full payload; those of revisits come from the responses that they refer to. `records` is a stored table."""
    responses = records.where("record_type = 'response'")
    wanted = records.where("record_type = 'revisit'")
    referred = scratch.save(responses.where(F.col("payload_bytes") > 0).join(wanted.select(F.col("refers_to").alias("page_id")).distinct(), "page_id", "left_semi").groupBy(F.col("page_id").alias("refers_to"), F.col("stored_digest").alias("digest")).agg(F.max("payload_bytes").alias("full_bytes")), "referred")
    met = wanted.join(referred, ["refers_to", "digest"], "left").select("page_id", "record_type", "target", F.col("full_bytes").alias("payload_bytes"), F.when(F.col("full_bytes").isNotNull(), F.col("digest")).alias("payload_digest"), "refers_to")
    return responses.select("page_id", "record_type", "target", "payload_bytes", F.col("stored_digest").alias("payload_digest"), "refers_to").unionByName(met)


def op2_revisit_resolution(spark, sf_dir):
    scratch = Scratch(spark, "warc")
    path = scratch.path("archives")
    write_archives(table(spark, sf_dir, "pages"), path, scratch)
    records = scratch.save(read_archives(spark, path), "records")
    return resolve(records, scratch).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
o AS (SELECT d, min(page_id) AS original FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN original < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original < page_id THEN original END AS refers_to
FROM p LEFT JOIN o ON p.d = o.d AND p.n >= 100
"""
