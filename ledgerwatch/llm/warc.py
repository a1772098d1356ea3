"""WARC archives with segmented records: writing, reading, reassembly and transfer decoding.

A record is an HTTP response whose body is sent in chunks.  Blocks above ``segment_bytes`` are cut
into a first record with segment number 1 and continuation records that name it as their origin;
the last one carries the total length.  A record's text ends in two line ends, which is the line
separator of Spark's text writer: archives are written by DataFrame expressions and the writer
alone, compressed by file, with at most ``file_records`` records of bounded size each, so that a
file always fits in a task.

Reading parses one file at a time into records, in one pass over pieces of bounded size: beside the
file's own bytes a task holds a record and a batch of output, and members may be as many as records.  Records without segments go on as they are; the
segments of the others are grouped by origin, put in order, checked for gaps and for the total
length, joined and decoded.  A group is one record, never more.

Of records with equal payloads of at least ``revisit_bytes`` the one with the smallest key is a
response, the others are revisits that refer to it.  Equal payloads are found by their SHA-256.

Null html is an empty payload, a null url leaves out the target, a null key the key.  Repeated rows
are records of their own (repeated rows of the smallest key are all responses).  Missing,
conflicting or short segments, broken chunks and cut files give a ``state`` other than ``ok``, never
an error.  Empty tables give empty archives, which read as no rows.  Other columns are ignored.
"""

import zlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import functions as F

from ledgerwatch.llm.staging import stage

END = "\r\n\r\n"
RECORDS = ("record_id string, type string, record_key string, refers_to string, uri string, "
           "digest string, segment int, origin string, total_length long, block binary, state string")


@dataclass(frozen=True)
class WarcConfig:
    revisit_bytes: int = 100
    chunk_bytes: int = 8192
    segment_bytes: int = 32768
    file_records: int = 2048
    date: str = "2024-01-01T00:00:00Z"


def _pieces(binary, size):
    """Byte pieces of at most ``size``, as strings of raw bytes; none for no bytes."""
    n = F.ceil(F.octet_length(binary) / size).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: binary.substr(i * size + 1, F.lit(size)).cast("string"))


def _line(name, value):
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def decisions(pages, config=WarcConfig(), key_col="page_id", html_col="html"):
    """(digest, first): payloads that more than one record has, and the key of the response."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    return (pages.filter(F.octet_length(html_col) >= config.revisit_bytes)
            .groupBy(F.sha2(payload, 256).alias("digest"))
            .agg(F.min(key_col).alias("first"), F.count("*").alias("n"))
            .filter("n > 1 AND first IS NOT NULL").drop("n"))


def build_records(pages, config=WarcConfig(), key_col="page_id", url_col="url", html_col="html"):
    """One row per record or segment: ``value`` holds its text without the final line ends."""
    rows = pages.select(
        F.col(key_col).alias("key"), F.regexp_replace(url_col, r"[\x00-\x20]", "%20").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    same = stage(decisions(pages, config, key_col, html_col), "warc-same")
    rows = rows.join(same, "digest", "left").withColumn(
        "revisit", F.coalesce(F.col("first") != F.col("key"), F.col("first").isNotNull()))
    chunks = F.array_join(F.transform(_pieces(F.col("payload"), config.chunk_bytes), lambda c: F.concat(
        F.hex(F.octet_length(c)), F.lit("\r\n"), c, F.lit("\r\n"))), "")
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    body = F.when(F.col("revisit"), F.lit(f"{http}\r\n")).otherwise(F.concat(
        F.lit(f"{http}Transfer-Encoding: chunked\r\n\r\n"), chunks, F.lit(f"0{END}")))
    rows = rows.select(
        F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")).alias("id"), "key", "url", "digest",
        "revisit", "first", body.cast("binary").alias("block"))
    n = F.greatest(F.ceil(F.octet_length("block") / config.segment_bytes), F.lit(1)).cast("int")
    cut = rows.select("*", n.alias("n"), F.explode(F.sequence(F.lit(1), n)).alias("at"))
    part = F.col("block").substr((F.col("at") - 1) * config.segment_bytes + 1,
                                 F.lit(config.segment_bytes))
    head, many = F.col("at") == 1, F.col("n") > 1
    kind = F.when(~head, "continuation").when(F.col("revisit"), "revisit").otherwise("response")
    own_id = F.when(head, F.col("id")).otherwise(
        F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))
    first = F.when(head, True)

    def only(condition, value):
        return F.when(condition, value)

    value = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", own_id),
        _line("WARC-Date", F.lit(config.date)), _line("WARC-Target-URI", F.col("url")),
        _line("Record-Key", only(first, F.col("key").cast("string"))),
        _line("Content-Type", only(first, F.lit("application/http; msgtype=response"))),
        _line("WARC-Payload-Digest", only(first, F.concat(F.lit("sha256:"), F.col("digest")))),
        _line("WARC-Profile", only(first & F.col("revisit"), F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("Refers-To-Key", only(first & F.col("revisit"), F.col("first").cast("string"))),
        _line("WARC-Segment-Number", only(many, F.col("at").cast("string"))),
        _line("WARC-Segment-Origin-ID", only(~head, F.col("id"))),
        _line("WARC-Segment-Total-Length", only(
            many & (F.col("at") == F.col("n")), F.octet_length("block").cast("string"))),
        _line("Content-Length", F.octet_length(part).cast("string")), F.lit("\r\n"),
        part.cast("string"))
    return cut.select(value.alias("value"))


def write_archives(pages, path, config=WarcConfig(), key_col="page_id", url_col="url",
                   html_col="html"):
    """Write ``pages`` as compressed archives below ``path``."""
    (build_records(pages, config, key_col, url_col, html_col).write
     .option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", config.file_records).text(path))


class _Input:
    """Bytes that come in pieces: ``at`` is where reading stands in what is held."""

    def __init__(self, pieces):
        self.pieces, self.held, self.at = iter(pieces), bytearray(), 0

    def more(self):
        """Take one more piece and forget what has been read; False at the end."""
        piece = next(self.pieces, None)
        if piece is None:
            return False
        del self.held[:self.at]
        self.at = 0
        self.held += piece
        return True

    def has(self, size):
        while len(self.held) - self.at < size:
            if not self.more():
                return False
        return True

    def take(self, size):
        out = bytes(self.held[self.at:self.at + size])
        self.at += size
        return out

    def upto(self, mark):
        """The bytes before ``mark``, which is passed over; None if it does not come."""
        seen = 0
        while True:
            found = self.held.find(mark, self.at + max(0, seen - len(mark) + 1))
            if found >= 0:
                out = self.take(found - self.at)
                self.at += len(mark)
                return out
            seen = len(self.held) - self.at
            if not self.more():
                return None


def parse_archive(data):
    """Yield the records of one archive as tuples of ``RECORDS``; damage ends it with one row.

    ``data`` is all of it or an iterable of pieces; no more than a record and a piece are held.
    """
    source = _Input([data] if isinstance(data, (bytes, bytearray, memoryview)) else data)
    while source.has(1):
        head = source.upto(b"\r\n\r\n")
        lines = head.split(b"\r\n") if head is not None else []
        fields = {}
        for line in lines[1:]:
            name, colon, value = line.partition(b":")
            fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
        size = fields.get(b"content-length", "")
        if not lines or not lines[0].startswith(b"WARC/") or not size.isdigit() \
                or not source.has(int(size)):
            yield (*[None] * 10, "damaged")
            return

        def number(name):
            text = fields.get(name, "")
            return int(text) if text.isdigit() else None

        digest = fields.get(b"warc-payload-digest")
        yield (fields.get(b"warc-record-id"), fields.get(b"warc-type"), fields.get(b"record-key"),
               fields.get(b"refers-to-key"), fields.get(b"warc-target-uri"),
               digest.partition(":")[2] if digest else None, number(b"warc-segment-number"),
               fields.get(b"warc-segment-origin-id"), number(b"warc-segment-total-length"),
               source.take(int(size)), "ok")
        while source.has(2) and source.held[source.at:source.at + 2] == b"\r\n":
            source.at += 2


def inflated(data, window=32_768, most=1_000_000):
    """The content of a file in pieces: all its gzip members, or the data itself.

    A member is fed a small window at a time, so what lies behind its end is not copied along; a
    piece has at most ``most`` bytes.  A cut file gives what there is.
    """
    view, at = memoryview(data), 0
    if view[:2] != b"\x1f\x8b":
        yield from (view[i:i + most] for i in range(0, len(view), most))
        return
    while view[at:at + 2] == b"\x1f\x8b":
        member = zlib.decompressobj(wbits=31)
        while not member.eof and at < len(view):
            fed = view[at:at + window]
            try:
                piece = member.decompress(fed, most)
            except zlib.error:
                return
            at += len(fed) - len(member.unused_data if member.eof else member.unconsumed_tail)
            if piece:
                yield piece
        while not member.eof:  # all is fed: what is still inside
            piece = member.decompress(member.unconsumed_tail, most)
            if not piece:
                return
            yield piece


def read_archives(spark, path, batch_bytes=16_000_000):
    """(``RECORDS``) of all archives below ``path``."""
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def run(batches):
        for b in batches:
            for content in b["content"]:
                rows, size = [], 0
                for record in parse_archive(inflated(content)):
                    rows.append(record)
                    size += len(record[9] or b"")
                    if size > batch_bytes:
                        yield pd.DataFrame(rows, columns=names).astype(WIDE)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype(WIDE)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(run, RECORDS)


WIDE = {"segment": "Int32", "total_length": "Int64"}


def decode(block):
    """(payload, state) of an HTTP response block, chunked or not."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"HTTP/"):
        return b"", "no_http"
    coded = any(line.lower().startswith(b"transfer-encoding:") and b"chunked" in line.lower()
                for line in head.split(b"\r\n")[1:])
    if not coded:
        return body, "ok"
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not size or any(c not in b"0123456789abcdefABCDEF" for c in size):
            return b"".join(out), "bad_chunk"
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(out), "ok"
        if body[at + n:at + n + 2] != b"\r\n":
            return b"".join(out), "bad_chunk"
        out.append(body[at:at + n])
        at += n + 2


def reassemble(records):
    """One row per logical record: its fields, ``blocks`` in order, and ``state``."""
    fields = ["record_id", "type", "record_key", "refers_to", "uri", "digest"]
    whole = records.filter("segment IS NULL").select(
        *fields, F.array("block").alias("blocks"), "state")
    parts = records.filter("segment IS NOT NULL").withColumn(
        "root", F.coalesce("origin", "record_id"))
    grouped = parts.groupBy("root").agg(
        *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in fields],
        F.max("total_length").alias("total"),
        F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("s"))
    numbers = F.transform("s", lambda p: p["segment"])
    length = F.aggregate("s", F.lit(0).cast("long"),
                         lambda sum_, p: sum_ + F.octet_length(p["block"]))
    state = (F.when(F.size(F.array_distinct(numbers)) < F.size("s"), "segment_conflict")
             .when((F.element_at(numbers, 1) != 1) | F.col("total").isNull()
                   | (F.element_at(numbers, -1) != F.size("s")), "segment_missing")
             .when(length != F.col("total"), "length_mismatch").otherwise("ok"))
    joined = grouped.select(
        F.coalesce("record_id", "root").alias("record_id"), *fields[1:],
        F.transform("s", lambda p: p["block"]).alias("blocks"), state.alias("state"))
    return whole.unionByName(joined)


def payloads(records):
    """Logical records with their decoded ``payload``; a revisit's is null."""

    @F.pandas_udf("payload binary, state string")
    def decoded(blocks: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decode(b"".join(b)) for b in blocks], columns=["payload", "state"])

    out = reassemble(records)
    good = (F.col("state") == "ok") & F.col("type").isin("response", "revisit")
    out = out.withColumn("d", F.when(good, decoded(F.when(good, F.col("blocks")).otherwise(
        F.array().cast("array<binary>")))))
    return out.select(
        "record_id", "type", "record_key", "refers_to", "uri", "digest",
        F.when(F.col("type") == "response", F.col("d.payload")).alias("payload"),
        F.coalesce("d.state", "state").alias("state"))


def catalogue(records, key_type="long"):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, state) of every record.

    Sizes and digests are those of the payload that was read back; a revisit has those of the
    response it refers to.
    """
    read = stage(payloads(records).select(
        F.col("record_key").cast(key_type).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("refers_to").cast(key_type).alias("refers_to"), "digest",
        F.when((F.col("type") == "response") & (F.sha2("payload", 256) != F.col("digest")),
               "digest_mismatch").otherwise(F.col("state")).alias("state")), "warc-read")
    responses = read.filter("record_type = 'response'")
    revisits = read.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    origin = responses.groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias(
        "digest")).agg(F.max("payload_bytes").alias("payload_bytes"))
    resolved = revisits.join(origin, ["refers_to", "digest"], "left").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type",
        "refers_to", F.when(F.col("payload_bytes").isNull(), "origin_missing").otherwise(
            F.col("state")).alias("state"))
    return responses.drop("digest").unionByName(resolved)


SQL = """
WITH p AS (
  SELECT page_id, encode(COALESCE(html, '')) AS body FROM pages
), q AS (
  SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM q
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to, 'ok' AS state
FROM f
"""
