"""Derived WARC records: metadata and plain-text conversion records for response records.

A derived record names the response it came from (WARC-Refers-To), keeps its target, date and
payload digest, and has an id that follows from the response's, so a repeated run gives the same
records.  The metadata record lists the response's own headers, the HTTP status and headers and
the page's title and links; the conversion record holds the text a reader sees.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CRLF = b"\r\n"
_SCHEMA = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, "
    "warc_date string, content_type string, payload_digest string, block_digest string, "
    "content_length long, record binary"
)
_SKIPPED = re.compile(r"<!--.*?(?:-->|$)|<(script|style|template|noscript|title)\b.*?(?:</\1\s*>|$)", re.S | re.I)
_BREAKS = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main"
    r"|nav|ol|option|p|pre|section|table|td|th|tr|ul)\b[^>]*(?:>|$)",
    re.I,
)
_TAGS = re.compile(r"<[!/?a-zA-Z][^>]*(?:>|$)")
_TITLE = re.compile(r"<title\b[^<>]*>", re.I)
_TITLE_END = re.compile(r"</title", re.I)
# A tag ends at the next angle bracket, so that unclosed tags are each read once.
_LINKS = re.compile(r"""<a\b[^<>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


# --- records as bytes --------------------------------------------------------------------


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _CRLF * 2 + block + _CRLF * 2


class Headers(dict):
    """A record's headers by name in lower case, the first of each; ``pairs`` has all, in order."""

    def __init__(self, lines: list[str]):
        self.pairs = [(k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in lines)]
        super().__init__(reversed(self.pairs))


def parse_records(data: bytes) -> Iterator[tuple[Headers, bytes]]:
    """Headers and block of each record; a torn last record is left out."""
    at = 0
    while (end := data.find(b"\r\n\r\n", at)) >= 0:
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        while lines and not lines[0].startswith("WARC/"):
            lines = lines[1:]
        headers = Headers(lines[1:])
        size = headers.get("content-length", "")
        if not size.isdigit() or end + 4 + int(size) > len(data):
            return
        yield headers, data[end + 4 : end + 4 + int(size)]
        at = end + 4 + int(size)
        while data[at : at + 2] == _CRLF:
            at += 2


def _named(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


def _line(value: str) -> str:
    """A header value: line breaks would end the header."""
    return re.sub(r"[\r\n]+", " ", value).strip()


def response_record(page_id: int | None, url: str, page: str, date: str) -> bytes:
    payload = page.encode("utf-8", "replace")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + payload
    payload_digest = digest(payload)
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", _named("response", str(page_id), url, payload_digest)),
        ("WARC-Target-URI", _line(url)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", payload_digest),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return record_bytes(headers, block)


def plain_text(page: str) -> str:
    """Text of a page: one line per block, white space joined, no markup, scripts, styles or title."""
    text = _SKIPPED.sub(" ", page)
    for space in "\t\r\n\f":  # no line of its own; runs of spaces go with the split below
        text = text.replace(space, " ")
    text = _TAGS.sub("", _BREAKS.sub("\n", text))
    lines = (" ".join(html.unescape(line).split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def _dechunked(data: bytes) -> bytes:
    """The content of a chunked body; what follows a torn chunk is lost."""
    parts, at = [], 0
    while (end := data.find(b"\r\n", at)) >= 0:
        size = data[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,8}", size) or not int(size, 16):
            break
        parts.append(data[end + 2 : end + 2 + int(size, 16)])
        at = end + 2 + int(size, 16) + 2
    return b"".join(parts)


def page_text(http: list[str], payload: bytes) -> str:
    """The page of a response: out of its chunks, unpacked and in its character set as its headers say.

    What cannot be unpacked is read as it is; an unknown character set is read as UTF-8.
    """
    of = {name.strip().lower(): value.strip().lower() for name, _, value in (line.partition(":") for line in http)}
    if "chunked" in of.get("transfer-encoding", "") and re.match(rb"[0-9A-Fa-f]+[;\r ]", payload):
        payload = _dechunked(payload)
    if (packed := of.get("content-encoding", "")) in ("gzip", "x-gzip", "deflate"):
        for bits in (47, -15):  # with a header, either kind, or without one
            try:
                payload = zlib.decompressobj(bits).decompress(payload)
                break
            except zlib.error:
                continue
    named = re.search(r"charset=[\"']?([\w.:-]+)", of.get("content-type", ""))
    try:
        return payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def _metadata_block(headers: Headers, status: str, http: list[str], page: str) -> bytes:
    lines = [f"source-{name}: {value}" for name, value in headers.pairs]
    lines += [f"http-status: {_line(status)}"] + [f"http-header: {_line(line)}" for line in http]
    title = _TITLE.search(page)
    if title and (end := _TITLE_END.search(page, title.end())):
        lines.append(f"title: {_line(html.unescape(page[title.end() : end.start()]))}")
    lines += [f"outlink: {_line(html.unescape(a or b or c))}" for a, b, c in _LINKS.findall(page)]
    return "\r\n".join(lines).encode("utf-8", "replace") + _CRLF


def derived(headers: Headers, block: bytes) -> Iterator[tuple[str, list[tuple[str, str]], bytes]]:
    """The metadata and the conversion record of one response: type, headers, block."""
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *http = head.decode("iso-8859-1").split("\r\n")
    page = page_text(http, payload)
    source = headers.get("warc-record-id", "")
    blocks = (
        ("metadata", "application/warc-fields", _metadata_block(headers, status, http, page)),
        ("conversion", "text/plain; charset=utf-8", plain_text(page).encode()),
    )
    for kind, content_type, made in blocks:
        yield kind, [
            ("WARC-Type", kind),
            ("WARC-Record-ID", _named(kind, source)),
            ("WARC-Refers-To", source),
            ("WARC-Target-URI", headers.get("warc-target-uri", "")),
            ("WARC-Date", headers.get("warc-date", "")),
            ("WARC-Payload-Digest", headers.get("warc-payload-digest") or digest(payload)),
            ("WARC-Block-Digest", digest(made)),
            ("Content-Type", content_type),
        ], made


# --- as frames ---------------------------------------------------------------------------


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``page_id`` and ``record``: a response record per row of ``pages``; null url or html count as empty."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch["page_id"], batch["url"], batch["html"], strict=True)
            made = [response_record(None if pd.isna(i) else int(i), url, page, date) for i, url, page in rows]
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "record": made})

    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("url", "html")]
    return pages.select(F.col("page_id").cast("long"), *empty).mapInPandas(build, "page_id long, record binary")


def derive(records: DataFrame) -> DataFrame:
    """Two rows, metadata and conversion, for each response among ``records`` (``page_id``, ``record``).

    ``record`` in the result is the whole derived record; the other columns repeat its headers.
    Records of other types, null and torn ones have nothing derived.  Repeated rows give repeated
    records, an empty table none.
    """

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in _SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for page_id, data in zip(batch["page_id"], batch["record"], strict=True):
                for headers, block in parse_records(data or b""):
                    if headers.get("warc-type") != "response":
                        continue
                    for kind, fields, made in derived(headers, block):
                        of = dict(fields)
                        rows.append((
                            page_id, kind, of["WARC-Record-ID"], of["WARC-Refers-To"], of["WARC-Target-URI"], of["WARC-Date"],
                            of["Content-Type"], of["WARC-Payload-Digest"], of["WARC-Block-Digest"], len(made), record_bytes(fields, made),
                        ))
                if len(rows) >= 500:
                    yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})

    return records.select(F.col("page_id").cast("long"), "record").mapInPandas(build, _SCHEMA)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``page_id`` (null), ``record``: the content of WARC files, a file in a row."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.lit(None).cast("long").alias("page_id"), F.col("content").alias("record"))


def text_of_record(record: Column, size: Column) -> Column:
    """The block of a record, its last ``size`` bytes before the two line ends, as text."""
    return F.decode(F.substring(record, F.octet_length(record) - size.cast("int") - 3, size.cast("int")), "utf-8")
