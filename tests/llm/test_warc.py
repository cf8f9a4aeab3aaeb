import base64
import gzip
import hashlib
import json
import random
import re
import time
import zlib
from html import unescape
from html.parser import HTMLParser
from pathlib import Path
from urllib.parse import urljoin

import pytest
from conftest import SF

from tidemark.llm import queries, warc

SKIPPED = {"script", "style", "noscript", "template", "head"}
BLOCKS = set(
    "address article aside blockquote br dd div dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li main "
    "nav ol p pre section table td th tr ul".split()
)


class Plain(HTMLParser):
    """A real parser, to hold the patterns against."""

    def __init__(self, base):
        super().__init__(convert_charrefs=True)
        self.base, self.text, self.links, self.skip, self.title, self.in_title = base, [], [], [], "", False

    def handle_starttag(self, tag, attrs):
        if tag in ("a", "area", "link", "img", "script", "iframe"):
            for name, value in attrs:
                if name in ("href", "src"):
                    self.links.append({"path": f"{tag}@{name}", "url": urljoin(self.base, (value or "").strip())})
                    break
        if tag in SKIPPED:
            self.skip.append(tag)
        if tag == "title":
            self.in_title = True
        if tag in BLOCKS and not self.skip:
            self.text.append("\n")

    def handle_endtag(self, tag):
        if self.skip and self.skip[-1] == tag:
            self.skip.pop()
        if tag == "title":
            self.in_title = False
        if tag in BLOCKS and not self.skip:
            self.text.append("\n")

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        if not self.skip:
            self.text.append(data)


def plain(html, base):
    parser = Plain(base)
    parser.feed(html)
    parser.close()
    lines = (" ".join(line.split()) for line in "".join(parser.text).split("\n"))
    return "\n".join(x for x in lines if x), parser.links, " ".join(parser.title.split())


def sha1(block):
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def squeezed(text):
    return "\n".join(x for x in (" ".join(line.split()) for line in text.split("\n")) if x)


def test_query_equals_a_parser(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op10_warc_derivatives(spark, SF).collect()
    assert len(rows) == 2 * len(pages)
    by_page = {}
    for r in rows:
        by_page.setdefault(r.page_id, {})[r.warc_type] = r
    for page_id, page in pages.items():
        meta, text = by_page[page_id]["metadata"], by_page[page_id]["conversion"]
        wanted, links, title = plain(page.html, page.url)
        assert squeezed(text.content) == wanted
        found = json.loads(meta.content)
        assert found["links"] == links and (found["title"] or "") == title
        assert ["Content-Type", "text/html; charset=utf-8"] in found["headers"]
        for r in (meta, text):
            assert r.target_uri == page.url and r.refers_to and r.record_id != r.refers_to
            assert r.block_digest == sha1(r.content.encode()) and r.content_length == len(r.content.encode())
            assert r.payload_digest == found["payload_digest"] == sha1(page.html.encode())
        assert meta.refers_to == text.refers_to
    assert len({r.record_id for r in rows}) == len(rows)


@pytest.fixture
def pages(spark):
    rows = [
        (1, "http://a.example/x/", "<html><head><title>A &amp; B</title></head><body><p>One<br>two<!-- no <a href='h'> --> &lt;3</p><a href='../y?q=1&amp;r=2'>y</a><script>if (a<b) x='<a href=z>'</script></body></html>"),
        (2, None, None),
        (3, "", ""),
        (4, "not a url", "no markup at all"),
        (5, "http://[bad", "<a href='http://[worse'>x</a>"),
        (5, "http://[bad", "<a href='http://[worse'>x</a>"),
        (None, "http://n.example/", "<p>unclosed <b>tags <script>never ends"),
        (6, "http://long.example/", "<p>" + "word " * 200_000 + "</p>"),
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_odd_pages(pages):
    rows = warc.derive(warc.responses(pages)).collect()
    assert len(rows) == 2 * pages.count()
    text = {r.page_id: bytes(r.block).decode() for r in rows if r.warc_type == "conversion"}
    meta = {r.page_id: json.loads(bytes(r.block)) for r in rows if r.warc_type == "metadata"}
    assert text[1] == "One\ntwo <3\ny"
    assert meta[1]["title"] == "A & B"
    assert [x["url"] for x in meta[1]["links"]] == ["http://a.example/y?q=1&r=2"]
    assert text[2] == text[3] == "" and meta[2]["links"] == []
    assert text[4] == "no markup at all" and text[None] == "unclosed tags"
    assert len(text[6].split()) == 200_000
    assert len({r.record_id for r in rows if r.page_id == 5}) == 2


def test_files_round_trip(spark, pages, folder):
    path = folder("warc")
    records = warc.responses(pages)
    both = records.unionByName(warc.derive(records))
    written = warc.write_warc(both, path).collect()
    assert sum(r.records for r in written) == 3 * pages.count()
    assert sum(r.bytes for r in written) == sum(p.stat().st_size for p in Path(path).glob("*.warc.gz"))
    columns = [c for c in both.columns if c not in ("page_id", "target_uri")]
    got = sorted(map(repr, warc.read_warc(spark, path).select(columns).collect()))
    assert got == sorted(map(repr, both.select(columns).collect()))
    # Derived again from the files, the records are the same.
    again = warc.derive(warc.read_warc(spark, path))
    ids = lambda df: sorted(r.block_digest for r in df.collect())
    assert ids(again) == ids(warc.derive(records))
    first = gzip.decompress(next(p for p in Path(path).glob("*.warc.gz") if p.stat().st_size).read_bytes())
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_other_records_and_sets(spark):
    body = "<p>caf\xe9</p>".encode("latin-1")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\nX-Own: a: b\r\n\r\n" + body
    rows = [
        (1, "response", "<urn:uuid:1>", None, "http://a/", "d", "t", "b", "p", block),
        (2, "request", "<urn:uuid:2>", None, "http://a/", "d", "t", "b", "p", block),
        (3, "response", "<urn:uuid:3>", None, "http://a/", "d", "t", "b", "p", b"no header"),
    ]
    found = warc.derive(spark.createDataFrame(rows, warc.RECORD_TYPE)).collect()
    assert [r.refers_to for r in found] == ["<urn:uuid:1>"] * 2 + ["<urn:uuid:3>"] * 2
    assert bytes(found[1].block).decode() == "café"
    assert ["X-Own", "a: b"] in json.loads(bytes(found[0].block))["headers"]


def test_no_pages_and_extra_columns(spark, pages):
    from pyspark.sql import functions as F

    assert warc.derive(warc.responses(pages.limit(0))).collect() == []
    wide = pages.withColumns({"block": F.lit(1), "record_id": F.lit("x"), "warc_type": F.lit("y")})
    assert warc.derive(warc.responses(wide)).count() == 2 * pages.count()


# The same by patterns that look to the end of the text again and again.
_SLOW_DROPPED = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|head)\b[^>]*>.*?(?:</\1\s*>|\Z)|<![^>]*>", re.S | re.I
)
_SLOW_SCRIPT = re.compile(r"<!--.*?(?:-->|\Z)|(<(script|style)\b[^>]*>).*?(?:</\2\s*>|\Z)", re.S | re.I)


def slow_text(html):
    text = warc._TAG.sub("", warc._BREAKS.sub("\n", _SLOW_DROPPED.sub(" ", html)))
    lines = (warc._BLANKS.sub(" ", line).strip() for line in unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def slow_title(html):
    found = re.search(r"<title\b[^>]*>(.*?)</title\s*>", html, re.S | re.I)
    return " ".join(unescape(found[1]).split()) if found else None


def slow_links(html):
    found = warc._LINK.findall(_SLOW_SCRIPT.sub(lambda m: m[1] or "", html))
    return [a[0].lower() for a in found if warc._ADDRESS.search(a[1])]


def test_markup_of_random_pages():
    rng = random.Random(2)
    parts = ["<!--", "-->", "<script", "</script>", "</script >", "<style>", "</style>", "<title>", "</title>", "<TITLE x",
             "<a href='u'", "<p", ">", "<", "!", " ", "x", "\n", "</p>", "<!doctype", "<head>", "</head>", "<br/>",
             "<img src=i>", "&lt;", "--"]
    for _ in range(20_000):
        html = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        assert warc.plain_text(html) == slow_text(html), html
        assert warc.title_of(html) == slow_title(html), html
        assert [r["path"].split("@")[0] for r in warc.links_of(html, "http://h/")] == slow_links(html), html


@pytest.mark.parametrize(
    "opener",
    ["<title>", "<title", "<a", "<a href='", '<a href="x" ', "<!--", "<!", "<script", "<script>", "<style ", "<p", "</p",
     "<head>", "</title ", "<", "&", "<a href=x><script>", "<!-- -"],
)
@pytest.mark.parametrize("end", ["", ">", "-->", "</title>"])
def test_a_megabyte_of_open_tags_takes_no_time(opener, end):
    html = opener * (1_000_000 // len(opener)) + end
    begin = time.perf_counter()
    warc.plain_text(html)
    warc.title_of(html)
    warc.links_of(html, "http://host/page")
    assert time.perf_counter() - begin < 6


def chunked(body, size=7):
    parts = [body[i : i + size] for i in range(0, len(body), size)]
    return b"".join(b"%x;note\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\nTrailer: x\r\n\r\n"


HTML = "<html><head><title>Größe</title></head><body><p>Ein Text</p></body></html>"


@pytest.mark.parametrize(
    ("headers", "encode"),
    [
        (["Transfer-Encoding: chunked"], chunked),
        (["Content-Encoding: gzip"], gzip.compress),
        (["content-encoding: x-gzip", "transfer-encoding: Chunked"], lambda b: chunked(gzip.compress(b))),
        (["Content-Encoding: deflate"], zlib.compress),
        (["Content-Encoding: deflate"], lambda b: zlib.compress(b, wbits=-15)),
        (["Content-Encoding: deflate, gzip"], lambda b: gzip.compress(zlib.compress(b))),
        # Headers that are not true, as captures of decoded bodies have them.
        (["Content-Encoding: gzip"], bytes),
        (["Transfer-Encoding: chunked"], bytes),
        (["Content-Encoding: br, unknown"], bytes),
    ],
)
def test_codings_of_bodies(spark, headers, encode):
    block = "\r\n".join(["HTTP/1.1 200 OK", *headers]).encode() + b"\r\n\r\n" + encode(HTML.encode())
    row = (1, "response", "<urn:x>", None, "http://h/", "2024-01-01T00:00:00Z", warc.HTTP_RESPONSE, "d", "p", block)
    derived = {r.warc_type: r for r in warc.derive(spark.createDataFrame([row], warc.RECORD_TYPE)).collect()}
    assert bytes(derived["conversion"].block).decode() == "Ein Text"
    assert json.loads(bytes(derived["metadata"].block))["title"] == "Größe"


def test_bodies_that_end_early():
    headers = ["HTTP/1.1 200 OK", "Transfer-Encoding: chunked"]
    whole = chunked(b"0123456789")
    assert warc.body_of(headers, whole) == b"0123456789"
    assert warc.body_of(headers, whole[:14]) == b"012345"
    assert warc.body_of(["", "Content-Encoding: gzip"], gzip.compress(b"abc" * 1000)[:-6]).startswith(b"abcabc")
