"""WARC derivatives: metadata and plain-text conversion records linked to their responses.

From each response record come two records:

* ``metadata`` (application/json): the source's WARC headers, its HTTP status
  line and headers, the HTML title and links;
* ``conversion`` (text/plain): the page's visible text, block elements on
  lines of their own, entities resolved.

Both carry WARC-Refers-To with the source's record id, its target URI and
date (WARC-Refers-To-Target-URI, WARC-Refers-To-Date), their own block
digest, and the source's payload digest as WARC-Source-Payload-Digest
(computed if the source has none). Record ids are name-based UUIDs of source
id and type, so a rerun gives the same records.

Files: each scan partition becomes one ``.warc.gz`` file with a gzip member
per record (the usual random-access form), written through ``pyarrow.fs`` to
the shared folder under a name that no other task attempt uses; the stored
index (type, ids, digests, file, offset, length) says which files count.
Responses are streamed, one at a time in memory; nothing is shuffled.

Defined cases: a null or empty page is a response with an empty body and
gives both records (empty text, no title); a null URL leaves the URI headers
out; control characters in a URL are percent-encoded, so no header can be
forged; a message without an HTTP header is all body; a head without end tag
ends at the first element or text that no head holds; repeated rows give
records of equal ids in each row's place; an empty table gives no file and
an empty index; extra columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion_ops.llm.common import col
from medallion_ops.llm.token_files import filesystem
from medallion_ops.session import materialize, scratch_path

INDEX = ("page_id bigint, record_type string, record_id string, refers_to string, target_uri string, "
         "block_digest string, source_payload_digest string, content_length bigint, file string, offset bigint, "
         "length bigint")
RECORD = ("page_id bigint, record_type string, record_id string, refers_to string, target_uri string, "
          "block_digest string, source_payload_digest string, content_length bigint, digest_ok boolean, block binary")
HIDDEN = re.compile(r"<!--|<(script|style|noscript|template|head)(?=[\s/>])[^>]*>", re.I)
CLOSE = {None: re.compile("-->")} | {
    x: re.compile(rf"</{x}\s*>", re.I) for x in ("script", "style", "noscript", "template", "title")}
# what a head can hold: its end tag may be left out, so anything else ends it
IN_HEAD = re.compile(r"\s+|<(script|style|title|noscript|template)(?=[\s/>])[^>]*>", re.I)
VOID = re.compile(r"</?(?:meta|link|base|basefont|bgsound|title|noscript|template)(?=[\s/>])[^>]*>", re.I)
HEAD_END = re.compile(r"</head\s*>", re.I)
TITLE_BEGIN, TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title\s*>", re.I)
LINK_BEGIN = re.compile(r"<(a|img|link|script|iframe)\b", re.I)
LINK_VALUE = re.compile(r"""\b(?:href|src)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
BLOCK = re.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr"
                   r"|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)\b[^>]*>", re.I)
TAG = re.compile(r"<[a-zA-Z/!?][^>]*>")
CONTROL = re.compile(r"[\x00-\x20\x7f]")
LINE_END = re.compile(r"[\r\n]+")
CHARSET = re.compile(r"charset=([\w.-]+)", re.I)


def responses_of_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                       date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of crawled pages: page_id, headers (map) and block (the HTTP message).

    The record id is a UUID of the page's id, URL and content digest.
    """
    body = F.coalesce(col(html_col), F.lit("")).cast("binary")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n")).cast("binary")
    key = F.md5(F.concat_ws("\x01", F.coalesce(col(id_col).cast("string"), F.lit("")),
                            F.coalesce(col(url_col), F.lit("")), F.sha1(body)).cast("binary"))
    name = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(key, "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-3$3-8$4-$5"),
                    F.lit(">"))
    headers = F.map_from_arrays(
        F.array(*map(F.lit, ("WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "Content-Type"))),
        F.array(F.lit("response"), name, F.lit(date), col(url_col), F.lit("application/http; msgtype=response")))
    return pages.select(col(id_col).cast("bigint").alias("page_id"),
                        F.map_filter(headers, lambda _, v: v.isNotNull()).alias("headers"),
                        F.concat(head, body).alias("block"))


def sha1_digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(block: bytes) -> tuple[str, dict[str, str], bytes]:
    """Status line, headers and body of an HTTP message; no header: all body."""
    if not block.startswith(b"HTTP/"):
        return "", {}, block
    head, _, body = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = (x.split(":", 1) for x in lines if ":" in x)
    return status, {k.strip(): v.strip() for k, v in pairs}, body


def head_end(page: str, at: int, unclosed: set[str]) -> int:
    """Where a head that begins at ``at`` ends: behind its end tag or before the first thing that no head holds.

    ``unclosed``: elements known to have no end from here on; added to.
    """
    while True:
        if page.startswith("<!--", at):
            close = page.find("-->", at + 4)
            at = close + 3 if close >= 0 else len(page)
            continue
        m = IN_HEAD.match(page, at)
        name = m[1].lower() if m and m[1] else None
        if m and name is None:
            at = m.end()
            continue
        if name and name not in unclosed:
            close = CLOSE[name].search(page, m.end())
            if close or name in ("script", "style"):
                at = close.end() if close else len(page)
                continue
            unclosed.add(name)                           # nor is there an end for later ones
        m = VOID.match(page, at)
        if not m:
            break
        at = m.end()
    end = HEAD_END.match(page, at)
    return end.end() if end else at


def without_hidden(page: str) -> str:
    """A page with a space for each comment and hidden element.

    Without its end, a comment, script or style runs to the end of the page
    (as in browsers); a noscript or template is shown and a head ends where
    something begins that no head holds, so no visible text goes with them.
    No tag begins behind the last ``>``, so none is looked for there.
    """
    out, at, unclosed, last = [], 0, set(), page.rfind(">") + 1
    begin = HIDDEN.search(page, at, last)
    while begin:
        name = begin[1].lower() if begin[1] else None
        if name == "head":
            end = head_end(page, begin.end(), unclosed)
        else:
            close = None if name in unclosed else CLOSE[name].search(page, begin.end())
            end = close.end() if close else len(page)
            if not close and name in ("noscript", "template"):
                unclosed.add(name)                       # nor is there an end for later ones
                end = begin.end()
        out += page[at:begin.start()], " "
        at = end
        begin = HIDDEN.search(page, at, last)
    comment = page.find("<!--", max(at, last))
    if comment >= 0:
        out += page[at:comment], " "
        at = len(page)
    return "".join([*out, page[at:]])


def _without(tags: re.Pattern, page: str, instead: str) -> str:
    last = page.rfind(">") + 1
    return tags.sub(instead, page[:last]) + page[last:]


def page_text(page: str) -> str:
    """Visible text: hidden elements and tags out, block elements as line breaks, entities resolved."""
    shown = _without(TAG, _without(BLOCK, without_hidden(page), "\n"), "")
    lines = html.unescape(shown).replace("\r", "\n").split("\n")
    return "\n".join(filter(None, [" ".join(x.split()) for x in lines]))


def page_title(page: str) -> str | None:
    """Content of the first title element that is closed; if the first one has no end, none has."""
    begin = TITLE_BEGIN.search(page)
    opened = page.find(">", begin.end()) if begin else -1
    end = TITLE_END.search(page, opened + 1) if opened >= 0 else None
    return page[opened + 1:end.start()] if end else None


def page_links(page: str) -> Iterator[tuple[str, str]]:
    """(tag, value) of the first href or src of each a, img, link, script and iframe tag, in one pass.

    A tag goes to the next ``>``. The next attribute and the next ``>`` are
    remembered, so tags without either do not read the page again.
    """
    at, value, close = 0, None, -1
    while begin := LINK_BEGIN.search(page, at):
        at = begin.end()
        if value is None or value.start() < at:
            value = LINK_VALUE.search(page, at)
            if value is None:
                return
        if close < at:
            close = page.find(">", at)
            close = close if close >= 0 else len(page)
        if value.start() <= close:
            yield begin[1], value[1] or value[2] or value[3] or ""
            at = value.end()


def _clean(value: str) -> str:
    return CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", value)


def _field(name: str, value: str) -> str:
    if name.endswith("URI"):
        value = _clean(value)
    elif "\n" in value or "\r" in value:
        value = LINE_END.sub(" ", value)
    return f"{name}: {value}\r\n"


def derived_records(headers: dict[str, str], block: bytes) -> list[tuple[dict[str, str], bytes]]:
    """The metadata and the conversion record of one response, as (headers, block)."""
    source, uri = headers.get("WARC-Record-ID", ""), headers.get("WARC-Target-URI")
    status, http, body = split_http(block)
    payload = headers.get("WARC-Payload-Digest") or sha1_digest(body)
    charset = CHARSET.search(http.get("Content-Type", ""))
    try:
        page = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    title = page_title(page)
    links = [{"path": f"{tag.upper()}@/{'href' if tag.lower() in ('a', 'link') else 'src'}", "url": html.unescape(value)}
             for tag, value in page_links(page)]
    about = {"Envelope": {
        "WARC-Header-Metadata": headers, "Payload-Digest": payload, "Block-Digest": sha1_digest(block),
        "HTTP-Response-Metadata": {
            "Response-Message": status, "Headers": http,
            "HTML-Metadata": {"Title": html.unescape(title).strip() if title is not None else None, "Links": links}}}}
    out = []
    for kind, content, data in (
            ("metadata", "application/json", json.dumps(about, ensure_ascii=False, sort_keys=True).encode()),
            ("conversion", "text/plain; charset=utf-8", page_text(page).encode("utf-8", "replace"))):
        own = {"WARC-Type": kind,
               "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}#{kind}')}>",
               "WARC-Date": headers.get("WARC-Date", "")}
        if uri is not None:
            own["WARC-Target-URI"] = uri
        own["WARC-Refers-To"] = source
        if uri is not None:
            own["WARC-Refers-To-Target-URI"] = uri
        own["WARC-Refers-To-Date"] = headers.get("WARC-Date", "")
        own |= {"WARC-Source-Payload-Digest": payload, "WARC-Block-Digest": sha1_digest(data), "Content-Type": content,
                "Content-Length": str(len(data))}
        out.append((own, data))
    return out


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    return b"WARC/1.1\r\n" + "".join(_field(k, v) for k, v in headers.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:20]!r}")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    return headers, rest[:int(headers["Content-Length"])]


def _member(data: bytes, level: int) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)          # 31: with a gzip header
    return squeeze.compress(data) + squeeze.flush()


def _derive(folder: str, level: int, flush: int = 2048):
    names = [x.split(" ")[0] for x in INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        out, name, offset, rows = None, "", 0, []

        def taken():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64() if n in ("page_id", "content_length", "offset", "length") else pa.string())
                 for n, c in zip(names, zip(*rows))], names=names)

        for batch in batches:
            blocks = batch.column(2)
            for i, (page, headers) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                block, headers = blocks[i].as_py(), json.loads(headers or "{}")
                if out is None:
                    store.create_dir(base, recursive=True)
                    name = f"derived-{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                for own, data in derived_records(headers, block or b""):
                    member = _member(record_bytes(own, data), level)
                    out.write(member)
                    rows.append((page, own["WARC-Type"], own["WARC-Record-ID"], own["WARC-Refers-To"],
                                 own.get("WARC-Target-URI"), own["WARC-Block-Digest"], own["WARC-Source-Payload-Digest"],
                                 len(data), name, offset, len(member)))
                    offset += len(member)
                if len(rows) >= flush:
                    yield taken()
                    rows = []
        if out is not None:
            out.close()
        if rows:
            yield taken()
    return run


def write_derivatives(responses: DataFrame, folder: str | None = None, level: int = 1) -> tuple[str, DataFrame]:
    """Writes the derived records of all responses; returns the folder and the stored index."""
    folder = folder or scratch_path(responses.sparkSession, "warc")
    rows = responses.select("page_id", F.to_json("headers").alias("headers"), "block")
    return folder, materialize(rows.mapInArrow(_derive(folder, level), INDEX), "warc_index")


def _read(folder: str, blocks: bool):
    names = [x.split(" ")[0] for x in RECORD.split(", ")]
    types = [pa.int64(), *[pa.string()] * 6, pa.int64(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        open_, file = "", None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["file"] != open_:
                    if file is not None:
                        file.close()
                    open_, file = r["file"], store.open_input_file(f"{base}/{r['file']}")
                file.seek(r["offset"])
                own, data = parse_record(gzip.decompress(file.read(r["length"])))
                rows.append((r["page_id"], own["WARC-Type"], own["WARC-Record-ID"], own["WARC-Refers-To"],
                             own.get("WARC-Target-URI"), own["WARC-Block-Digest"], own["WARC-Source-Payload-Digest"],
                             len(data), own["WARC-Block-Digest"] == sha1_digest(data), data if blocks else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)
        if file is not None:
            file.close()
    return run


def read_records(folder: str, index: DataFrame, blocks: bool = True) -> DataFrame:
    """The derived records that ``index`` names, read from their files and checked against their digests."""
    wanted = index.select("page_id", "file", "offset", "length")
    return wanted.mapInArrow(_read(folder, blocks), RECORD)
