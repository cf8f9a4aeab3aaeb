"""Derived records of web captures: links and metadata, and plain text.

Every ``response`` record gives a ``metadata`` record (title, headers, links as JSON) and
a ``conversion`` record (its text), both of which refer to the response by its id and
keep its URI and date. Records are rows; ``write_warc`` and ``read_warc`` turn them into
files with one gzip member per record and back.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, map_batches
from tidemark.llm.files import located, replaced

# Names and forms that the WARC 1.1 format prescribes.
VERSION = "WARC/1.1"
HTTP_RESPONSE = "application/http; msgtype=response"
PLAIN_TEXT = "text/plain"
JSON_TYPE = "application/json"

RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("warc_type", pa.string()),
        ("record_id", pa.string()),
        ("refers_to", pa.string()),
        ("target_uri", pa.string()),
        ("warc_date", pa.string()),
        ("content_type", pa.string()),
        ("block_digest", pa.string()),
        ("payload_digest", pa.string()),
        ("block", pa.binary()),
    ]
)
RECORD_TYPE = (
    "page_id bigint, warc_type string, record_id string, refers_to string, target_uri string, "
    "warc_date string, content_type string, block_digest string, payload_digest string, block binary"
)
CAPTURED = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # of names that are URLs


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: object) -> str:
    """The same id on every run, so that a retried task writes the same record."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, ' '.join(map(str, parts)))}>"


# Each of these, tried at a "<", either fails within a few characters or matches, as long as
# a ">" follows somewhere; texts are searched up to their last one, so time grows with the text.
_DROPPED = re.compile(
    r"<!--.*?(?:-->|(\Z))|<(script|style|noscript|template|head)\b[^>]*>.*?(?:</\2\s*>|(\Z))|<![^>]*>",
    re.S | re.I,
)
_BREAKS = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|figure|footer|form|h[1-6]|header|hr|li|main|"
    r"nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>",
    re.I,
)
_TAG = re.compile(r"</?[a-zA-Z][^>]*>")
_TITLE = re.compile(r"<title\b[^>]*>", re.I)
_TITLE_END = re.compile(r"</title\s*>", re.I)
_LINK = re.compile(r"<(a|area|link|img|script|iframe)\b([^>]*)>", re.I)
_ADDRESS = re.compile(r"""\b(href|src)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SCRIPT_TEXT = re.compile(
    r"<!--.*?(?:-->|(\Z))|<(script|style)\b[^>]*>.*?(?:</\2\s*>|(\Z))", re.S | re.I
)
_BLANKS = re.compile(r"[ \t\f\v\r\xa0]+")


def _without(spans: re.Pattern, html: str, instead: Callable[[re.Match], str]) -> str:
    """``html`` with what ``spans`` finds replaced; a span that is not closed goes to the end.

    Groups 1 and 3 tell that a comment or an element is not closed. Beyond the last ``>``
    nothing but an open comment can begin.
    """
    last = html.rfind(">") + 1
    out, at = [], 0
    for found in spans.finditer(html, 0, last):
        out += [html[at : found.start()], instead(found)]
        at = found.end()
        if found[1] is not None or found[3] is not None:
            return "".join(out)
    comment = html.find("<!--", last)
    if comment < 0:
        return "".join([*out, html[at:]])
    return "".join([*out, html[at:comment], " " if spans is _DROPPED else ""])


def _replaced(tags: re.Pattern, text: str, by: str) -> str:
    last = text.rfind(">") + 1
    return tags.sub(by, text[:last]) + text[last:]


def plain_text(html: str) -> str:
    """Visible text, one line per block; blanks are squeezed and empty lines left out."""
    shown = _without(_DROPPED, html, lambda _: " ")
    text = _replaced(_TAG, _replaced(_BREAKS, shown, "\n"), "")
    lines = (_BLANKS.sub(" ", line).strip() for line in unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def title_of(html: str) -> str | None:
    """The text of the first title that is closed, which is the first if any is."""
    opened = _TITLE.search(html, 0, html.rfind(">") + 1)
    closed = _TITLE_END.search(html, opened.end()) if opened else None
    return " ".join(unescape(html[opened.end() : closed.start()]).split()) if closed else None


def _opening(found: re.Match) -> str:
    """The tag of a script or style, without what stands inside; nothing of a comment."""
    return found[0][: found[0].index(">") + 1] if found[2] else ""


def links_of(html: str, base: str) -> list[dict[str, str]]:
    """Addresses in the order of the page, resolved against its own."""
    out = []
    # What stands inside scripts is no markup; their own tag is.
    markup = _without(_SCRIPT_TEXT, html, _opening)
    for tag, attributes in _LINK.findall(markup, 0, markup.rfind(">") + 1):
        if found := _ADDRESS.search(attributes):
            raw = unescape(found[2] or found[3] or found[4] or "").strip()
            try:
                url = urljoin(base, raw)
            except ValueError:  # an address that is none, such as an open bracket
                url = raw
            out.append({"path": f"{tag.lower()}@{found[1].lower()}", "url": url})
    return out


def http_block(html: str) -> bytes:
    body = html.encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body


def _split_http(block: bytes) -> tuple[list[str], bytes]:
    head, blank, body = block.partition(b"\r\n\r\n")
    if not blank:
        return [], block
    return head.decode("latin-1").split("\r\n"), body


def _named(headers: list[str], name: str) -> str:
    """The value of a header, in lower case; empty without it."""
    for line in headers[1:]:
        key, _, value = line.partition(":")
        if key.strip().lower() == name:
            return value.strip().lower()
    return ""


def _unchunked(body: bytes) -> bytes:
    """The chunks of a body in a row; the body itself where it is not made of chunks."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not size or size.strip(b"0123456789abcdefABCDEF"):
            # The file may end early; what came counts.
            return b"".join(out) if out else body
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(out)
        out.append(body[at : at + n])
        at += n + 2


def _inflated(body: bytes, coding: str) -> bytes:
    """The body without its compression; as it is where it has none that can be read."""
    if coding not in ("gzip", "x-gzip", "deflate"):
        return body
    for bits in (47, -15) if coding == "deflate" else (47,):
        inflate = zlib.decompressobj(wbits=bits)
        try:
            return inflate.decompress(body) or body
        except zlib.error:
            continue
    return body


def body_of(headers: list[str], body: bytes) -> bytes:
    """What a response carries, once its transfer and content codings are taken off."""
    if _named(headers, "transfer-encoding").endswith("chunked"):
        body = _unchunked(body)
    for coding in reversed(_named(headers, "content-encoding").split(",")):
        body = _inflated(body, coding.strip())
    return body


def _text_of(headers: list[str], body: bytes) -> str:
    """The body in the character set that its headers name, else as UTF-8."""
    named = [m[1] for h in headers[1:] if (m := re.match(r"(?i)content-type:.*charset=\"?([\w.:-]+)", h))]
    try:
        return body.decode(named[0] if named else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def responses(pages: DataFrame, date: str = CAPTURED) -> DataFrame:
    """Response records of ``pages (page_id, url, html)``, one per row.

    NULL html is an empty body; a NULL url stays NULL and its record has no target.
    Rows that repeat whole get the same record id.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for page, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    block = http_block(html or "")
                    payload = digest((html or "").encode())
                    own = record_id("response", page, url, date, payload)
                    yield page, "response", own, None, url, date, HTTP_RESPONSE, digest(block), payload, block

        yield from batches_of(rows(), RECORD, 512)

    rows = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    return map_batches(rows, work, RECORD_TYPE)


def _derived(record: dict) -> Iterator[tuple]:
    headers, body = _split_http(record["block"] or b"")
    html = _text_of(headers, body_of(headers, body))
    uri, source = record["target_uri"], record["record_id"]
    pairs = [h.partition(":") for h in headers[1:]]
    links = links_of(html, uri or "")
    meta = {
        "status": headers[0] if headers else None,
        "headers": [[k.strip(), v.strip()] for k, _, v in pairs],
        "payload_digest": record["payload_digest"],
        "title": title_of(html),
        "links": links,
    }
    for kind, mime, block in (
        ("metadata", JSON_TYPE, json.dumps(meta, ensure_ascii=False).encode()),
        ("conversion", PLAIN_TEXT, plain_text(html).encode()),
    ):
        found = digest(block)
        own = record_id(kind, source, found)
        # The payload digest stays that of the source, by which both can be traced.
        yield (
            record["page_id"], kind, own, source, uri, record["warc_date"], mime, found,
            record["payload_digest"], block,
        )


def derive(records: DataFrame) -> DataFrame:
    """The metadata and the conversion record of every response record; others are passed by.

    Each page is worked on by itself: no row meets another, so nothing is shuffled.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for record in batch.to_pylist():
                    yield from _derived(record)

        yield from batches_of(rows(), RECORD, 512)

    wanted = records.where(F.col("warc_type") == "response").select(*RECORD.names)
    return map_batches(wanted, work, RECORD_TYPE)


def serialized(record: dict) -> bytes:
    """A record as the format has it, before compression."""
    block = record["block"] or b""
    fields = [
        ("WARC-Type", record["warc_type"]),
        ("WARC-Record-ID", record["record_id"]),
        ("WARC-Date", record["warc_date"]),
        ("WARC-Target-URI", record["target_uri"]),
        ("WARC-Refers-To", record["refers_to"]),
        ("WARC-Block-Digest", record["block_digest"]),
        ("WARC-Payload-Digest", record["payload_digest"]),
        ("Content-Type", record["content_type"]),
        ("Content-Length", str(len(block))),
    ]
    # A line break inside a value would end the header.
    lines = [f"{k}: {' '.join(v.split())}" for k, v in fields if v is not None]
    head = "\r\n".join([VERSION, *lines]) + "\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(member: bytes) -> dict:
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    length = int(fields["Content-Length"])
    return {
        "warc_type": fields.get("WARC-Type"),
        "record_id": fields.get("WARC-Record-ID"),
        "refers_to": fields.get("WARC-Refers-To"),
        "target_uri": fields.get("WARC-Target-URI"),
        "warc_date": fields.get("WARC-Date"),
        "content_type": fields.get("Content-Type"),
        "block_digest": fields.get("WARC-Block-Digest"),
        "payload_digest": fields.get("WARC-Payload-Digest"),
        "block": rest[:length],
    }


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Write one ``.warc.gz`` per task when the result is used: ``path, records, bytes``.

    A file appears under its name only when it is whole, and a task that runs again
    writes it anew.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/part-{TaskContext.get().partitionId():07d}.warc.gz"
        written = size = 0
        with replaced(path) as out:
            for batch in batches:
                for record in batch.to_pylist():
                    member = gzip.compress(serialized(record), mtime=0)
                    out.write(member)
                    written, size = written + 1, size + len(member)
        schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        yield from batches_of([(path, written, size)], schema)

    wanted = records.select(*RECORD.names)
    return map_batches(wanted, work, "path string, records bigint, bytes bigint")


def _members(stream) -> Iterator[bytes]:
    """The uncompressed members of a gzip file, one at a time."""
    inflate, held = zlib.decompressobj(wbits=31), []
    while chunk := stream.read(1 << 20):
        while chunk:
            held.append(inflate.decompress(chunk))
            chunk = inflate.unused_data
            if inflate.eof:
                yield b"".join(held)
                inflate, held = zlib.decompressobj(wbits=31), []
    if any(held):
        raise ValueError("the file ends inside a record")


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all ``.warc.gz`` files under ``folder``, streamed file by file.

    The columns are those of ``derive``; ``page_id`` is NULL, for files do not hold it.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for path in batch.column(0).to_pylist():
                    files, at = located(path)
                    with files.open_input_stream(at, compression=None) as stream:
                        for member in _members(stream):
                            record = parse(member)
                            yield tuple(record.get(n) for n in RECORD.names)

        yield from batches_of(rows(), RECORD, 512)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return map_batches(found.select("path"), work, RECORD_TYPE)
