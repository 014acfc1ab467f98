"""Legacy web archives (ARC 1 and 2) converted to WARC 1.1, and WARC archives written and read.

An ARC record is a header line, whose fields depend on the archive's version, and a body of the declared length. Each
becomes a WARC record with a synthesised identifier, timestamp, type and digests.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastops.llm.text import utf8
from forecastops.session import shared_folder, small_side, store

#: Fields of the header lines of ARC versions 1 and 2.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"),
}
_CRLF = b"\r\n"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space
#: Records of one archive file at most.
FILE_RECORDS = 1000


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def parse_arc(data: bytes, version: int | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, body) of each record of an ARC file.

    The version comes from the file's own description record, else from ``version``, else from the number of fields. Bodies
    are taken by their declared length. A header line that fits no version, or a body shorter than declared, raises.
    """
    at = 0
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)].decode("utf-8").rstrip("\r")
        parts = line.split(" ")
        found = version if version is not None else next((v for v, names in ARC_FIELDS.items() if len(names) == len(parts)), None)
        if line.startswith("filedesc:"):
            found = next((v for v, names in ARC_FIELDS.items() if len(names) == len(parts)), None)
        if found is None or len(parts) != len(ARC_FIELDS[found]):
            raise ValueError(f"no ARC header line: {line[:200]!r}")
        fields = dict(zip(ARC_FIELDS[found], parts))
        size = int(fields["length"])
        if end < 0 or end + 1 + size > len(data):
            raise ValueError(f"an ARC body is shorter than declared: {line[:200]!r}")
        body = data[end + 1 : end + 1 + size]
        at = end + 1 + size
        if fields["url"].startswith("filedesc:"):
            described = re.match(rb"(\d+) ", body)
            version = int(described[1]) if described and int(described[1]) in ARC_FIELDS else version
        yield fields, body


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its blank line, and payload; the head is empty if there is none."""
    if body.startswith(b"HTTP/"):
        end = body.find(b"\r\n\r\n")
        if end >= 0:
            return body[: end + 4], body[end + 4 :]
    return b"", body


def arc_to_warc(fields: dict[str, str], body: bytes, refers_to: str | None = None, more: dict[str, str] | None = None) -> bytes:
    """The WARC record of an ARC record, without the two line ends that follow it.

    ``refers_to`` makes it a revisit, which keeps the HTTP head but not the payload. The identifier is a name-based UUID of
    address, date and payload digest, so a second conversion gives the same.
    """
    head, payload = split_http(body)
    when = fields["date"].ljust(14, "0")
    kind = "warcinfo" if fields["url"].startswith("filedesc:") else "revisit" if refers_to else "response" if head else "resource"
    content = {"warcinfo": "text/plain", "resource": fields["type"]}.get(kind, "application/http; msgtype=response")
    block = head if kind == "revisit" else body
    lines = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(_NAMESPACE, ' '.join([fields['url'], when, digest(payload), *(more or {}).values()]))}>",
        "WARC-Date": f"{when[:4]}-{when[4:6]}-{when[6:8]}T{when[8:10]}:{when[10:12]}:{when[12:14]}Z",
        "WARC-Target-URI": fields["url"],
        "WARC-IP-Address": fields["ip"],
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        **({"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": refers_to} if refers_to else {}),
        **(more or {}),
        "Content-Type": content,
        "Content-Length": str(len(block)),
    }
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()).encode() + _CRLF + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of each record of a WARC file, plain or gzip; names of header lines in lower case."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        if data.startswith(_CRLF, at):
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
        header = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
        size = int(header["content-length"])
        if end + 4 + size > len(data):
            raise ValueError(f"the WARC block at byte {at} is shorter than declared")
        yield header, data[end + 4 : end + 4 + size]
        at = end + 4 + size


def _arc_record(url: Column, html: Column, version: Column) -> Column:
    """Record of an ARC archive for a page: header line of the version and an HTTP response as body."""
    body = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), html)
    size = F.octet_length(body).cast("string")
    address = F.regexp_replace(F.coalesce(url.cast("string"), F.lit("about:blank")), r"[\s\p{Cntrl}]", "%20")
    one = F.concat_ws(" ", address, F.lit("0.0.0.0"), F.lit("20000101000000"), F.lit("text/html"), size)
    two = F.concat_ws(" ", address, F.lit("0.0.0.0"), F.lit("20000101000000"), F.lit("text/html"), F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages.arc"), size)
    return F.concat(F.when(version == 1, one).otherwise(two), F.lit("\n"), body)


def planned(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url", least: int = 0) -> DataFrame:
    """(id, record, version, refers_to): each page's ARC record, and for a revisit the page it refers to.

    Of pages with equal payloads of ``least`` bytes or more, the one with the largest id is the response. Payloads are
    compared by their SHA-1; only digests are grouped, combined on the map side, and only digests found twice are joined.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    digests = pages.select(F.sha1(utf8(F.col(html_col))).alias("sha1"), F.col(id_col).alias("id"), F.octet_length(html).alias("size")).filter(F.col("size") >= least)
    firsts = digests.groupBy("sha1").agg(F.max("id").alias("first"), F.count("*").alias("n")).filter("n > 1").select(F.col("sha1").alias("its_sha1"), "first")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(utf8(F.col(html_col))).alias("sha1"))
    rows = rows.join(small_side(store(firsts)), (F.col("sha1") == F.col("its_sha1")) & (F.octet_length("html") >= least), "left")
    version = F.when(F.col("id").isNull() | (F.pmod(F.xxhash64("id"), F.lit(2)) == 0), 1).otherwise(2)
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.select("id", version.alias("version"), _arc_record(F.col("url"), F.col("html"), version).alias("record"), refers.alias("refers_to"))


def convert(records: DataFrame) -> DataFrame:
    """``value``: the WARC record of each ARC record. ``records`` has id, version, record and refers_to; ids travel as text,
    as a column of integers with nulls would become one of floats."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page, version, record, refers in zip(batch["id"], batch["version"], batch["record"], batch["refers_to"]):
                fields, body = next(parse_arc(record.encode(), int(version)))
                _, payload = split_http(body)
                target = None if refers is None else f"<urn:page:{refers}>"
                more = {"X-Page-Id": page or "", "X-Payload-Length": str(len(payload))}
                out.append(arc_to_warc(fields, body, target, more).decode())
            yield pd.DataFrame({"value": out})

    texts = [F.col(c).cast("string").alias(c) for c in ("id", "refers_to")]
    return records.select("version", "record", *texts).mapInPandas(run, "value string")


def write_warc(records: DataFrame, path: str) -> None:
    """Write WARC records as gzip archives. The text writer ends each with the two line ends that WARC asks for."""
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def read_warc(spark, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records of all archives below ``path``.

    Length and digest of a stored payload are computed from it and must equal the declared ones.
    """
    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for header, block in parse_warc(content):
                    _, payload = split_http(block)
                    size, declared = int(header["x-payload-length"]), header["warc-payload-digest"].removeprefix("sha1:")
                    if header["warc-type"] == "response" and (len(payload) != size or digest(payload) != declared):
                        raise ValueError(f"payload of {header['warc-record-id']} differs from its header")
                    page, refers = header["x-page-id"], header.get("warc-refers-to")
                    rows.append((page or None, size, declared, header["warc-type"], refers[10:-1] if refers else None))
                yield pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    ids = {c: F.col(c).cast("long") for c in ("page_id", "refers_to")}
    return files.mapInPandas(run, schema).withColumns(ids)


def archive_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url", least: int = 0) -> DataFrame:
    """Write a WARC record per page through its ARC record and read the archives back; see :func:`read_warc` for the rows.

    Null pages have an empty payload; a null id is written as none; rows that repeat the largest id of a payload are all
    responses; an empty table gives no rows. The archives stay in the shared folder.
    """
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(convert(planned(pages, id_col, html_col, url_col, least)), path)
    return read_warc(spark, path).withColumnRenamed("page_id", id_col)
