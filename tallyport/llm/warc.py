"""WARC derivatives: responses become linked metadata and plain-text conversion records.

A response is a row with record id, target URI, date, its WARC headers and the HTTP message
as bytes. Each gives two records: `metadata` (application/warc-fields: title, language,
links, and the source's own HTTP headers) and `conversion` (text/plain). Both refer to the
response by WARC-Refers-To, keep its target, date and payload digest, and carry digests of
their own blocks. Record ids are derived from the response's id, so a repeated run writes
the same records. `warc_text` renders records for a text writer whose line separator is the
end of a WARC record; one file of it is a WARC file.

Rows are independent: one pass, no shuffle, and a response's size is all a task holds. A
page is scanned once from left to right; what is never closed is looked for once only, so
time grows with the page and not with its square.

Defined results: a NULL or empty message gives records with empty blocks; a message without
a header part is taken as a body; a body that does not decode has replacement characters;
a NULL target or date leaves the header out; line breaks and what follows them in header
values, targets and dates become a space; a response without record id is named by its
target, date and payload, and is referred to by those; comments and hidden elements that are
not closed hide nothing; responses that repeat give records that repeat; an empty table
gives no records; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.common import map_arrow

SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs
RECORD_END = "\r\n\r\n"
# What a tag begins with, by kind. Elements that are not shown, and those that begin a line.
OPENS_HIDDEN = re.compile(r"(?i)<(script|style|noscript|template|head)\b")
CLOSES = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "noscript", "template", "head", "title")}
BREAKS = re.compile(r"(?i)</?(?:p|br|div|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|pre|blockquote|hr)\b")
TITLE, HTML, ANCHOR = (re.compile(rf"(?i)<{name}\b") for name in ("title", "html", "a"))
LANG = re.compile(r"(?i)\blang\s*=\s*[\"']?([\w-]+)")
HREF = re.compile(r"(?i)\bhref\s*=\s*")
BARE = re.compile(r"[^\s>]+")
LINE_BREAK = re.compile(r"[\r\n]+[ \t]*")
CHARSET = re.compile(r"(?i)charset\s*=\s*[\"']?([\w-]+)")

SCHEMA = (
    "record_type string, record_id string, refers_to string, target_uri string, date string, "
    "headers map<string,string>, block binary"
)


def digest_of(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, name)}>"


def split_message(message: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """HTTP headers in order, and the body."""
    if not message.startswith(b"HTTP/"):
        return [], message
    head, _, body = message.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    return [(k.strip(), v.strip()) for k, sep, v in (line.partition(":") for line in lines) if sep], body


def decode(body: bytes, headers: list[tuple[str, str]]) -> str:
    kind = next((v for k, v in headers if k.lower() == "content-type"), "")
    named = CHARSET.search(kind)
    try:
        return body.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


class Page:
    """A page read from left to right. What stands next is looked up once and remembered until it is passed."""

    def __init__(self, text: str):
        self.text = text
        self.ahead: dict[object, tuple[int, int] | None] = {}

    def next(self, what: str | re.Pattern, at: int) -> tuple[int, int] | None:
        """Where the next `what` from `at` on begins and ends; None if there is none."""
        known = self.ahead.get(what, (-1, -1))
        if known is not None and known[0] < at:
            if isinstance(what, str):
                found = self.text.find(what, at)
                known = (found, found + len(what)) if found >= 0 else None
            else:
                found = what.search(self.text, at)
                known = found.span() if found else None
            self.ahead[what] = known
        return known

    def tags(self, kind: re.Pattern) -> Iterator[tuple[int, int]]:
        """Begin and end of each tag of a kind; the last one may lack its end."""
        at = 0
        while opening := kind.search(self.text, at):
            closing = self.next(">", opening.end())
            if closing is None:
                return
            yield opening.start(), closing[1]
            at = closing[1]

    def shown(self, at: int = 0, end: int | None = None) -> str:
        """The text between tags, line ends where an element begins a line, without what is hidden."""
        out: list[str] = []
        end = len(self.text) if end is None else end
        while (mark := self.text.find("<", at, end)) >= 0:
            out.append(self.text[at:mark])
            hidden = OPENS_HIDDEN.match(self.text, mark)
            if self.text.startswith("<!--", mark):
                close = self.next("-->", mark + 4)
            else:
                close = self.next(CLOSES[hidden[1].lower()], hidden.end()) if hidden else None
            if close:
                out.append(" ")
            elif (close := self.next(">", mark + 1)) is None:
                out.append(self.text[mark:end])
                return "".join(out)
            elif BREAKS.match(self.text, mark):
                out.append("\n")
            at = close[1]
        return "".join([*out, self.text[at:end]])


def flat(text: str) -> str:
    return " ".join(html.unescape(text).split())


def plain_text(page: str) -> str:
    """Visible text: a line for each block, entities resolved, white space collapsed."""
    return "\n".join(filter(None, map(flat, Page(page).shown().split("\n"))))


def title_of(page: str) -> str | None:
    for _, after in Page(page).tags(TITLE):
        close = CLOSES["title"].search(page, after)
        return flat(Page(page).shown(after, close.start())) if close else None
    return None


def language_of(page: str) -> str | None:
    found = (LANG.search(page, *tag) for tag in Page(page).tags(HTML))
    return next((f[1] for f in found if f), None)


def links(page: str) -> list[str]:
    """Targets of links in order, without repeats."""
    found, scan = [], Page(page)
    for begin, end in scan.tags(ANCHOR):
        named = HREF.search(page, begin, end)
        if not named:
            continue
        quote = page[named.end() : named.end() + 1]
        close = scan.next(quote, named.end() + 1) if quote in ("'", '"') else None
        bare = BARE.match(page, named.end())
        found.append(page[named.end() + 1 : close[0]] if close else bare[0] if bare else "")
    clean = ("".join(html.unescape(x).split()) for x in found)
    return list(dict.fromkeys(x for x in clean if x))


def one_line(value: str | None) -> str | None:
    """A header value: line breaks would end the header, or the record's head."""
    return None if value is None else LINE_BREAK.sub(" ", value).strip()


def record(kind: str, source: dict, content_type: str, block: bytes, payload_digest: str) -> tuple:
    """One record of `kind` that refers to `source`; headers in the order they are written."""
    named = source["record_id"] or f"{source['target_uri']} {source['date']} {payload_digest}"
    record_id = urn(f"{kind} {named}")
    headers = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Refers-To", source["record_id"]),
        ("WARC-Target-URI", source["target_uri"]), ("WARC-Date", source["date"]),
        ("WARC-Refers-To-Target-URI", source["target_uri"]), ("WARC-Refers-To-Date", source["date"]),
        ("WARC-Block-Digest", digest_of(block)), ("X-Source-Payload-Digest", payload_digest),
        *((f"X-Source-{k}", v) for k, v in sorted((source["headers"] or {}).items()) if v is not None),
        ("Content-Type", content_type), ("Content-Length", str(len(block))),
    ]
    return (
        kind, record_id, source["record_id"], source["target_uri"], source["date"],
        [(one_line(k).replace(":", ""), one_line(v)) for k, v in dict(headers).items() if v is not None], block,
    )


def derivatives(source: dict) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    headers, body = split_message(source["message"] or b"")
    page, payload = decode(body, headers), digest_of(body)
    fields = [
        ("title", title_of(page)), ("language", language_of(page)),
        *((f"http-{k.lower()}", v) for k, v in headers), *(("outlink", x) for x in links(page)),
    ]
    block = "".join(f"{k}: {one_line(v)}\r\n" for k, v in fields if v).encode("utf-8", "replace") if body or headers else b""
    text = plain_text(page).encode("utf-8", "replace")
    return [
        record("metadata", source, "application/warc-fields", block, payload),
        record("conversion", source, "text/plain; charset=utf-8", text, payload),
    ]


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string()] * 5 + [pa.map_(pa.string(), pa.string()), pa.binary()]
    names = ["record_type", "record_id", "refers_to", "target_uri", "date", "headers", "block"]
    for whole in batches:
        for start in range(0, whole.num_rows, 500):
            batch = whole.slice(start, 500)
            sources = batch.to_pylist()
            for source in sources:
                source["headers"] = dict(source["headers"] or [])
            rows = [r for s in sources for r in derivatives(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names
            )


def derive(responses: DataFrame) -> DataFrame:
    """responses: record_id, target_uri, date, headers map<string,string>, message binary."""
    return map_arrow(responses.select("record_id", "target_uri", "date", "headers", "message"), _derive, SCHEMA)


def warc_text(records: DataFrame) -> DataFrame:
    """One column `value`: the record as text, to be written with `write_warc`."""
    lines = F.concat_ws("\r\n", F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return records.select(F.concat(F.lit("WARC/1.1\r\n"), lines, F.lit(RECORD_END), F.decode("block", "UTF-8")).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files below `path`, gzipped as a whole; each ends its records with two line ends."""
    warc_text(records).write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


def responses_of(pages: DataFrame) -> DataFrame:
    """The pages table as response records: ids from page and URL, one second a page."""
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    name = F.sha2(F.concat_ws(" ", F.col("page_id").cast("string"), F.coalesce("url", F.lit(""))), 256)
    dashed = F.concat_ws(
        "-", F.substring(name, 1, 8), F.substring(name, 9, 4), F.concat(F.lit("8"), F.substring(name, 14, 3)),
        F.concat(F.lit("a"), F.substring(name, 18, 3)), F.substring(name, 21, 12),
    )
    seconds = F.lit(1_700_000_000) + F.col("page_id")
    return pages.select(
        F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">")).alias("record_id"), F.col("url").alias("target_uri"),
        F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        F.create_map(F.lit("Page-Number"), F.col("page_id").cast("string")).alias("headers"),
        F.concat(F.encode(head, "UTF-8"), body).alias("message"),
    )


def digest(pages: DataFrame) -> DataFrame:
    """Each derived record of the pages table with its links, digests and size."""
    return derive(responses_of(pages)).select(
        F.col("headers")["X-Source-Page-Number"].cast("long").alias("page_id"), "record_type", "record_id", "refers_to",
        "target_uri", "date", F.col("headers")["WARC-Block-Digest"].alias("block_digest"),
        F.col("headers")["X-Source-Payload-Digest"].alias("payload_digest"),
        F.length("block").cast("long").alias("block_bytes"), F.decode("block", "UTF-8").alias("text"),
    )
