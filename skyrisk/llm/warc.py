"""Derived WARC records: metadata and plain text of HTTP responses.

A response record is a row with its record id, target, date, and the HTTP message as bytes.
From each, two records are derived: `metadata` (title, language, character set, out-links and
the source's HTTP headers, as warc-fields) and `conversion` (the page as plain text). Both
refer to the response by its id, repeat its target, date and payload digest, and carry digests
of their own blocks. Ids are name-based, so that a task that runs again writes the same records.

Null pages are empty responses and give records with empty blocks; texts of any length are
converted whole (memory follows the longest page of a batch); repeated rows give repeated
records with equal ids; a null target stays null and its header is left out; an empty table
gives no records. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.texts import slices

NO_DATE = "1970-01-01T00:00:00Z"  # date of responses whose source has none
NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:derived-warc-records")

_BLOCKS = (
    r"<\s*/?\s*(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main|nav"
    r"|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>"
)
_BLOCK = re.compile(f"(?is){_BLOCKS}")
_UNSEEN = r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)|<!\[CDATA\[|\]\]>"
# A head ends at its end tag, at the body or at the first block tag outside its own elements.
_HIDDEN = re.compile(
    rf"(?is){_UNSEEN}|<head\b[^>]*>(?:<!--.*?-->|<(script|style|template|noscript|title)\b.*?</\2\s*>|[^<]++|(?!</head\b|<body\b|{_BLOCKS})<)*+(?P<end></head\s*>|\Z)?"
)
_OF_HEAD = re.compile(rf"(?is){_UNSEEN}|<title\b.*?</title\s*>")
_TAG = re.compile(r"(?s)<[/!?a-zA-Z][^>]*>?")
_TITLE = re.compile(r"(?is)<title[^>]*>(.*?)</title")
_LANG = re.compile(r"""(?is)<html[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""")
_LINK = re.compile(r"""(?is)<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_CHARSET = re.compile(r"""(?i)charset\s*=\s*["']?([\w.-]+)""")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, chr(10).join(parts))}>"


def http_message(body: bytes, content_type: str = "text/html; charset=utf-8") -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body


def split_http(message: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body; a message without a header block is all body."""
    head, gap, body = message.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return "", [], message
    status, *lines = head.decode("latin-1").split("\r\n")
    pairs = (line.partition(":") for line in lines if ":" in line)
    return status, [(name.strip(), value.strip()) for name, _, value in pairs], body


def _shown(hidden: re.Match) -> str:
    """A head without an end loses its own elements only; other hidden parts go."""
    return _OF_HEAD.sub(" ", hidden[0]) if hidden["end"] == "" else " "


def plain_text(page: str) -> str:
    """Visible text: hidden parts go, block tags end lines, entities are read, white space
    is joined, empty lines go."""
    text = _TAG.sub("", _BLOCK.sub("\n", _HIDDEN.sub(_shown, page)))
    lines = (" ".join(line.split()) for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def page_fields(page: str, target: str | None, headers: list[tuple[str, str]], status: str) -> str:
    """The metadata block: one `name: value` a line."""
    out = [("source-status", status)] if status else []
    out += [(f"source-{name.lower()}", value) for name, value in headers]
    if m := _TITLE.search(page):
        out.append(("title", " ".join(html.unescape(m[1]).split())))
    if m := _LANG.search(page):
        out.append(("language", m[1]))
    for m in _LINK.finditer(page):
        link = html.unescape(next(g for g in m.groups() if g is not None)).strip()
        try:
            out.append(("outlink", " ".join(urljoin(target or "", link).split())))
        except ValueError:  # not an address at all
            out.append(("outlink", " ".join(link.split())))
    return "".join(f"{name}: {value}\r\n" for name, value in out)


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", date: str = NO_DATE) -> DataFrame:
    """Response records of stored pages: key, record_id, target_uri, date, message."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "page"):
                keys, urls, bodies = (part.column(i).to_pylist() for i in range(3))
                messages = [http_message((b or "").encode("utf-8", "replace")) for b in bodies]
                ids = [record_id("response", str(k), u or "", digest(m)) for k, u, m in zip(keys, urls, messages, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.string()), part.column(1), pa.array([date] * len(ids)), pa.array(messages, pa.binary())],
                    ["key", "record_id", "target_uri", "date", "message"],
                )

    key_type = pages.schema[key].dataType.simpleString()
    chosen = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("page"))
    out = chosen.mapInArrow(run, f"key {key_type}, record_id string, target_uri string, date string, message binary")
    return out.withColumnRenamed("key", key)


def derive(records: DataFrame, key: str = "page_id") -> DataFrame:
    """Two records per response: key, warc_type, record_id, refers_to, target_uri, date,
    content_type, payload_digest (of the source), block_digest, content_length, block."""
    names = ["warc_type", "record_id", "refers_to", "target_uri", "date", "content_type", "payload_digest", "block_digest", "content_length", "block"]

    def both(source: str, target: str | None, date: str, message: bytes) -> Iterator[tuple]:
        status, headers, body = split_http(message)
        kind = next((v for n, v in headers if n.lower() == "content-type"), "")
        charset = (_CHARSET.search(kind) or _CHARSET.search(body[:2048].decode("latin-1")) or ["", "utf-8"])[1]
        try:
            page = body.decode(charset, "replace")
        except LookupError:
            page = body.decode("utf-8", "replace")
        payload = digest(body)
        for name, content, block in (
            ("metadata", "application/warc-fields", page_fields(page, target, headers, status)),
            ("conversion", "text/plain; charset=UTF-8", plain_text(page)),
        ):
            raw = block.encode("utf-8", "replace")
            yield name, record_id(name, source), source, target, date, content, payload, digest(raw), len(raw), raw.decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "message"):
                rows = [r for x in zip(*(part.column(i).to_pylist() for i in range(1, 5)), strict=True) for r in both(*x)]
                twice = pa.array([i for i in range(part.num_rows) for _ in range(2)], pa.int64())
                columns = [pa.array(c, pa.int64() if n == "content_length" else pa.string()) for n, c in zip(names, zip(*rows, strict=True), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(twice), *columns], [key, *names])

    key_type = records.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, " + ", ".join(f"{n} {'long' if n == 'content_length' else 'string'}" for n in names)
    return records.select(key, "record_id", "target_uri", "date", "message").mapInArrow(run, schema)


def serialised(derived: DataFrame, compress: bool = True) -> DataFrame:
    """The derived records as bytes in `record`: one WARC/1.1 record, by default one gzip
    member, so that records written one behind another are a valid archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "block"):
                out = []
                for r in part.to_pylist():
                    fields = {
                        "WARC-Type": r["warc_type"], "WARC-Record-ID": r["record_id"], "WARC-Refers-To": r["refers_to"],
                        "WARC-Target-URI": r["target_uri"], "WARC-Refers-To-Target-URI": r["target_uri"], "WARC-Date": r["date"],
                        "WARC-Refers-To-Date": r["date"], "WARC-Payload-Digest": r["payload_digest"],
                        "WARC-Block-Digest": r["block_digest"], "Content-Type": r["content_type"], "Content-Length": r["content_length"],
                    }
                    head = "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in fields.items() if v is not None)
                    raw = head.encode() + b"\r\n" + r["block"].encode() + b"\r\n\r\n"
                    out.append(gzip.compress(raw, mtime=0) if compress else raw)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary())], names)

    columns = ["warc_type", "record_id", "refers_to", "target_uri", "date", "content_type", "payload_digest", "block_digest", "content_length", "block"]
    names = ["record_id", "warc_type", "record"]
    ordered = derived.select("record_id", "warc_type", *[c for c in columns if c not in ("record_id", "warc_type")])
    return ordered.mapInArrow(run, "record_id string, warc_type string, record binary")
