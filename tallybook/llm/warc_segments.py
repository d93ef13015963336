"""WARC archives of pages: written as segmented records with chunked payloads, and reassembled on reading.

Records are lines of a text file whose separator is the record's version line, so
Spark's text reader splits archives of any size between tasks. The writer ends a
chunk inside the version line wherever a payload holds it, and ends no chunk, segment
or header right after the version, so the separator never occurs inside a record, which is checked. A block longer than a segment is cut: its first part is the record of the page, the
others are continuation records that name the first one's id, their number and,
in the last, the total length.

Reading: records that are not segmented are decoded where they lie. Segments are
grouped by origin, put in order of their numbers and joined, if all numbers from 1
are there and the lengths add up to the total; otherwise ``damage`` says what is
wrong and there is no payload. A group is the parts of one record, never more.

A null html is an empty payload, a null url has no target header, a null page id
comes back as null. Rows that repeat a page id are records of their own. Equal
payloads of at least ``least`` bytes are stored once: the row with the largest page
id is the response, the others refer to it (rows of that same page id are all
responses; payloads whose ids are all null are stored each time).
"""

import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import slices
from tallybook.operators.load import written

VERSION = "WARC/1.1\r\n"
#: The version without its line end: what comes after a chunk, a segment or a header begins with one.
NAME = VERSION.strip().encode()
#: Bytes of a record's block at most, and of one chunk of a payload.
SEGMENT, CHUNK = 1 << 14, 1 << 12
# The headers of the stored answer, what may stand in a target unquoted, and the profile of a revisit.
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
URI = ":/?#[]@!$&'()*+,;=%~-._"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _cuts(data: bytes, size: int, more: list[int] = ()) -> list[int]:
    """Places to cut UTF-8 at about every ``size`` bytes, never inside a character or after the version, and at ``more``."""
    out = {len(data), *more}
    for at in range(size, len(data), size):
        while data[at] & 0xC0 == 0x80:
            at -= 1
        out.add(at - 4 if data[max(at - len(NAME), 0):at] == NAME else at)
    return sorted(out - {0})


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunks; a chunk ends inside every version line, which so never stands whole.

    A chunk that ended in the version would have the framing's line end after it, so none does, nor the last.
    """
    ends = _cuts(payload, size, [m.start() + 4 for m in re.finditer(re.escape(NAME) + rb"(?=\r\n|\Z)", payload)])
    parts = (payload[a:b] for a, b in zip([0, *ends], ends))
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over. Broken framing is a ValueError."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk's size line is missing")
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = end + 2 + size
        if body[at:at + 2] != b"\r\n":
            raise ValueError("a chunk is not as long as it says")
        out.append(body[end + 2:at])
        at += 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP answer, its transfer framing taken off."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        raise ValueError("no end of the HTTP headers")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head) else body


def _record(kind: str, head: list[str], block: bytes) -> str:
    lines = [f"{VERSION}WARC-Type: {kind}", *head, f"Content-Length: {len(block)}"]
    record = "\r\n".join(lines) + "\r\n\r\n" + block.decode()
    if (record + "\r\n\r\n").count(VERSION) != 1:
        raise ValueError(f"the record separator stands inside a record: {head[0]}")
    return record


def _page_records(page, row, url, html, digest, keeper) -> Iterator[str]:
    name = f"urn:page:{page or 'null'}:{row}"
    head = [f"WARC-Record-ID: <{name}>", f"WARC-Payload-Digest: sha1:{digest}"]
    # a URL that ends in the version would make the separator with the header's line end
    head += [f"WARC-Target-URI: {re.sub(r'WARC/1[.]1$', 'WARC/1.%31', quote(url, safe=URI))}"] if url else []
    if keeper:
        yield _record("revisit", [*head, f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{keeper}>"], HTTP)
        return
    block = HTTP + chunked((html or "").encode())
    ends = _cuts(block, SEGMENT)
    if len(ends) == 1:
        yield _record("response", head, block)
        return
    for k, (a, b) in enumerate(zip([0, *ends], ends), 1):
        more = [f"WARC-Segment-Number: {k}"] + [f"WARC-Segment-Total-Length: {len(block)}"] * (b == len(block))
        if k == 1:
            yield _record("response", head + more, block[a:b])
        else:
            own = [f"WARC-Record-ID: <{name}:{k}>", f"WARC-Segment-Origin-ID: <{name}>"]
            yield _record("continuation", own + more, block[a:b])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            rows = zip(*(part.column(c).to_pylist() for c in part.schema.names))
            values = [record for row in rows for record in _page_records(*row)]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.large_string()).cast(pa.string())], ["value"])


def write_archive(pages: DataFrame, path: str, scratch: str, least: int = 1000, key: str = "page_id",
                  url: str = "url", html: str = "html") -> None:
    """One record per row under ``path``; ``scratch`` takes the list of payloads that are there more than once."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"),
                        F.sha1(payload).alias("digest"), F.length(payload).alias("n"))
    copies = (rows.where(F.col("n") >= least).groupBy("digest")
              .agg(F.max("page_id").alias("keeper"), F.count("*").alias("rows"))
              .where("rows > 1 AND keeper IS NOT NULL").select(F.col("digest").alias("copy"), "keeper"))
    told = rows.join(written(copies, scratch), F.col("digest") == F.col("copy"), "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    records = told.select(
        F.col("page_id").cast("string").alias("page"), F.monotonically_increasing_id().alias("row"), "url",
        F.when(~revisit, F.col("html")).alias("html"), "digest",
        F.when(revisit, F.col("keeper")).cast("string").alias("keeper"))
    records.mapInArrow(_records, "value string").write.text(path, lineSep="\r\n\r\n")


def _header(head: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(head, rf"(?im)^{name}: *([^\r\n]*)", 1), F.lit(""))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(kind, record_id, origin, segment, total, refers_to, digest, url, block, whole) per record of an archive.

    ``whole`` is false if the record's block is shorter than its header says.
    """
    raw = spark.read.text(path, lineSep=VERSION).where("length(value) > 0")
    data = raw.select(F.substring_index("value", "\r\n\r\n", 1).alias("head"), F.col("value").cast("binary").alias("data"))
    head, length = F.col("head"), _header(F.col("head"), "Content-Length").cast("int")
    begin = F.octet_length(head) + 5
    return data.select(
        _header(head, "WARC-Type").alias("kind"), _header(head, "WARC-Record-ID").alias("record_id"),
        _header(head, "WARC-Segment-Origin-ID").alias("origin"),
        _header(head, "WARC-Segment-Number").cast("int").alias("segment"),
        _header(head, "WARC-Segment-Total-Length").cast("long").alias("total"),
        _header(head, "WARC-Refers-To").alias("refers_to"),
        _header(head, "WARC-Payload-Digest").alias("digest"), _header(head, "WARC-Target-URI").alias("url"),
        F.substring(F.col("data"), begin, length).alias("block"),
        (F.octet_length("data") >= F.octet_length(head) + 4 + length).alias("whole"))


def reassemble(records: DataFrame) -> DataFrame:
    """(kind, record_id, refers_to, digest, url, payload, damage) per response, revisit or other first record.

    ``payload`` is the body without its transfer framing; it is null for a
    revisit, and where ``damage`` names what is wrong.
    """
    kept = ["kind", "record_id", "refers_to", "digest", "url"]
    single = records.where("segment IS NULL").select(
        *kept, "block", F.when(~F.col("whole"), "a record is cut short").alias("damage"))
    parts = records.where("segment IS NOT NULL").select(
        F.coalesce("origin", "record_id").alias("record"), "segment", "total", "whole", "block",
        F.struct(*kept).alias("of"))
    grouped = parts.groupBy("record").agg(
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        F.max("total").alias("total"), F.bool_and("whole").alias("whole"),
        F.min_by("of", "segment").alias("of"))
    numbers = F.sequence(F.lit(1), F.size("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda all_, part: F.concat(all_, part["block"]))
    joined = grouped.select("of", "total", "whole", (F.transform("parts", lambda p: p["segment"]) == numbers).alias("all"),
                            joined.alias("block"))
    damage = (F.when(~F.col("whole"), "a record is cut short")
              .when(~F.col("all"), "a segment is missing or there twice")
              .when(F.col("total").isNull(), "the last segment is missing")
              .when(F.octet_length("block") != F.col("total"), "the total length differs"))
    whole = joined.select(*[F.col(f"of.{c}").alias(c) for c in kept], "block", damage.alias("damage"))
    return single.unionByName(whole).mapInArrow(_payloads, PAYLOADS)


PAYLOADS = "kind string, record_id string, refers_to string, digest string, url string, payload binary, damage string"


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, len(batch), 256):
            part = batch.slice(first, 256)
            payloads, damages = [], []
            for kind, block, damage in zip(*(part.column(c).to_pylist() for c in ("kind", "block", "damage"))):
                payload = None
                if kind == "response" and damage is None:
                    try:
                        payload = payload_of(block or b"")
                    except ValueError as error:
                        damage = str(error)
                payloads.append(payload)
                damages.append(damage)
            kept = [part.column(c) for c in ("kind", "record_id", "refers_to", "digest", "url")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(payloads, pa.binary()), pa.array(damages, pa.string())],
                ["kind", "record_id", "refers_to", "digest", "url", "payload", "damage"])


def page_report(archive: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, damage) per page of a reassembled archive.

    A revisit has the size of the response that it refers to, found by the digest.
    """
    page = F.regexp_extract("record_id", r"^<urn:page:(-?\d+):\d+>$", 1)
    rows = archive.where("kind IN ('response', 'revisit')").select(
        F.nullif(page, F.lit("")).cast("long").alias("page_id"), F.octet_length("payload").cast("long").alias("own_bytes"),
        F.coalesce(F.sha1("payload"), F.regexp_replace("digest", "^sha1:", "")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.nullif(F.regexp_extract("refers_to", r"^<urn:page:(-?\d+)>$", 1), F.lit("")).cast("long").alias("refers_to"),
        "damage")
    return rows


def with_revisits(rows: DataFrame, scratch: str) -> DataFrame:
    """Page rows with the sizes of revisits taken from their responses; ``scratch`` takes the rows in between."""
    rows = written(rows, scratch)
    asked = rows.where("record_type = 'revisit'").select(F.col("payload_digest").alias("digest")).distinct()
    sizes = (rows.where("record_type = 'response'").join(asked, F.col("payload_digest") == F.col("digest"), "left_semi")
             .groupBy(F.col("payload_digest").alias("digest")).agg(F.max("own_bytes").alias("bytes")))
    return rows.join(sizes, (F.col("payload_digest") == F.col("digest")) & (F.col("record_type") == "revisit"),
                     "left").select("page_id", F.coalesce("own_bytes", "bytes").alias("payload_bytes"),
                                    "payload_digest", "record_type", "refers_to", "damage")
