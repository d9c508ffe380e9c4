"""WARC derivatives: linked metadata and plain-text records of responses."""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = b"WARC/1.1"
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-derivatives")
CAPTURED = "2024-01-01T00:00:00Z"

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)"
    r"|<(/?[a-z][a-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[/!?a-z][^>]*>",
    re.S | re.I,
)
LINK = re.compile(r"\b(href|src)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# Elements that end a line of text: fixed values.
BLOCKS = frozenset(
    "address article aside blockquote body br dd div dl dt figure footer form h1 h2 h3 h4 h5 h6 head header hr li main "
    "nav ol p pre section table td th title tr ul".split()
)

COLUMNS = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, content_type string, "
    "content_length long, block_digest string, source_digest string, n_links int, record binary"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, chr(0).join(parts))}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """The bytes of a record; its length is added to the headers."""
    lines = [*headers, ("Content-Length", str(len(block)))]
    clean = "".join(f"{name}: {' '.join(value.split())}\r\n" for name, value in lines)
    return VERSION + b"\r\n" + clean.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[list[tuple[str, str]], bytes] | None:
    """Headers in their order and the block of one record; None if it is none."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        return None
    headers = [(name.strip(), value.strip()) for name, colon, value in (x.partition(":") for x in lines[1:]) if colon]
    length = next((v for n, v in headers if n.lower() == "content-length"), "")
    if not length.isdigit() or int(length) > len(rest):
        return None
    return headers, rest[: int(length)]


def response(page_id: int | None, url: str | None, body: str | None) -> bytes:
    """A response record as a crawler would have written it."""
    payload = (body or "").encode("utf-8", "replace")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    headers = [
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", str(page_id), url or "", digest(payload))),
        ("WARC-Date", CAPTURED), ("WARC-Target-URI", url or ""), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)),
    ]
    return record(headers, block)


def plain_text(page: str) -> tuple[str, str, list[str]]:
    """The text, the title and the links of a page."""
    parts: list[str] = []
    links: list[str] = []
    title, begun, at = "", -1, 0
    for found in MARKUP.finditer(page):
        parts.append(page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name.strip("/") in BLOCKS:
            parts.append("\n")
        if name == "title" and begun < 0:
            begun = len(parts)
        elif name == "/title" and begun >= 0 and not title:
            title = html.unescape("".join(parts[begun:]))
        if found[3]:
            links += [html.unescape(x[1] or x[2] or x[3]) for x in LINK.findall(found[3])]
    parts.append(page[at:])
    lines = (" ".join(line.split()) for line in html.unescape("".join(parts)).split("\n"))
    return "\n".join(x for x in lines if x), " ".join(title.split()), links


def derive_one(data: bytes | None) -> list[tuple]:
    """The derivatives of one record, as rows without ``page_id``.

    A response gives a metadata record and a conversion record; other types
    give nothing; what is no record gives one row of type ``invalid``.
    """
    parsed = parse(data or b"")
    if parsed is None:
        return [("invalid", *[None] * 9)]
    headers, block = parsed
    known = {name.lower(): value for name, value in reversed(headers)}
    if known.get("warc-type") != "response":
        return []
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *fields = head.decode("latin-1").split("\r\n")
    fields = [(n.strip(), v.strip()) for n, colon, v in (x.partition(":") for x in fields) if colon]
    kind = next((v for n, v in fields if n.lower() == "content-type"), "")
    named = re.search(r"charset\s*=\s*\"?([\w.:-]+)", kind, re.I)
    try:
        page = payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    text, title, links = plain_text(page) if "html" in kind.lower() or not kind else (page, "", [])
    source = known.get("warc-record-id", "")
    target = known.get("warc-target-uri", "")
    own_digest = known.get("warc-payload-digest") or digest(payload)
    about = {
        "source-headers": headers, "http-status": status, "http-headers": fields, "title": title, "links": links,
        "payload-digest": own_digest, "computed-payload-digest": digest(payload), "payload-length": len(payload),
        "text-length": len(text),
    }
    out = []
    blocks = (
        ("metadata", "application/json", json.dumps(about, ensure_ascii=False).encode("utf-8", "replace")),
        ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")),
    )
    ids = [record_id(name, source, own_digest) for name, _, _ in blocks]
    for (name, content, body), own, other in zip(blocks, ids, reversed(ids), strict=True):
        lines = [
            ("WARC-Type", name), ("WARC-Record-ID", own), ("WARC-Date", known.get("warc-date", CAPTURED)),
            ("WARC-Refers-To", source), ("WARC-Target-URI", target), ("WARC-Concurrent-To", other),
            ("WARC-Source-Payload-Digest", own_digest), ("Content-Type", content), ("WARC-Block-Digest", digest(body)),
        ]
        out.append((name, own, source, target, content, len(body), digest(body), own_digest, len(links), record(lines, body)))
    return out


def responses(pages: DataFrame) -> DataFrame:
    """(page_id, record): a response record for each page; a null url or html counts as empty."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array([response(*r) for r in rows], pa.binary())], names=["page_id", "record"]
            )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(build, "page_id long, record binary")


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of every response in ``records`` (page_id, record).

    Each refers to its response and to the other one, and keeps the response's
    headers, target and digests. Repeated records give repeated derivatives with
    the same identifiers; a null ``page_id`` is kept. See ``derive_one``.
    """
    kinds = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.string(), pa.int32(), pa.binary()]
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column("page_id").to_pylist()
            for begin in range(0, len(pages), 256):
                rows = [
                    (page, *row)
                    for page, data in zip(pages[begin : begin + 256], batch.column("record").slice(begin, 256).to_pylist(), strict=True)
                    for row in derive_one(data)
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
                    )

    return records.select(F.col("page_id").cast("long").alias("page_id"), "record").mapInArrow(run, COLUMNS)
