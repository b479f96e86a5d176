"""WARC derivatives: metadata and plain-text conversion records that are linked to their response records.

Records follow ISO 28500 (WARC 1.1). A derivative keeps the response's WARC-Record-ID in WARC-Refers-To, its target
URI and date, its HTTP headers and its payload digest; its own block has a digest of its own.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafloom.llm import common, html_text

_HREF = re.compile(r"<a\b([^>]*)>", re.I)
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)
_LANG = re.compile(r"<html\b([^>]*)>", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9._:-]+)", re.I)
_META = re.compile(rb"<meta\b[^>]*?charset\s*=\s*[\"']?([A-Za-z0-9._:-]+)", re.I)
_MARKS = ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))
#: Bytes of a page in which its own charset is looked for, as browsers do.
META_BYTES = 1024
RESPONSE = "record_id string, target_uri string, date string, http_headers string, payload_digest string, payload binary"
DERIVED = "record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, source_headers string, source_payload_digest string, block_digest string, content_length long, block string"


def digest(data: bytes) -> str:
    """``sha1:`` and the base32 digest, as WARC files write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """A record id that follows from its parts, so reruns and retried tasks agree."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def responses(pages: DataFrame, url_col: str = "url", html_col: str = "html", key_col: str = "page_id", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of crawled pages, with the key column beside them.

    A null page is an empty payload, a null url an empty target. The record id follows from key, url and payload, so
    exact repeats of a row share it.
    """

    def run(frames):
        for f in frames:
            out = []
            for key, url, page in zip(f["key"], f["url"], f["html"], strict=True):
                payload, url = (page or "").encode(), url or ""
                own = digest(payload)
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                out.append((key, record_id("response", str(key), url, own), url, date, head, own, payload))
            yield pd.DataFrame(out, columns=["key", "record_id", "target_uri", "date", "http_headers", "payload_digest", "payload"])

    rows = pages.select(F.col(key_col).cast("string").alias("key"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInPandas(run, f"key string, {RESPONSE}")


def http_fields(headers: str | None) -> dict[str, str]:
    """The fields of an HTTP head, names in lower case; lines without a name are passed over, the last of a name counts."""
    pairs = (line.partition(":") for line in (headers or "").splitlines()[1:])
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def body(headers: str | None, payload: bytes) -> bytes:
    """A payload without the transfer and content codings that its head names; what does not decode stays as it is."""
    fields = http_fields(headers)
    if "chunked" in fields.get("transfer-encoding", "").lower():
        out, at = [], 0
        while (end := payload.find(b"\r\n", at)) >= 0:
            try:
                size = int(payload[at:end].split(b";")[0], 16)
            except ValueError:
                return payload
            if not size:
                break
            out.append(payload[end + 2 : end + 2 + size])
            at = end + 4 + size
        payload = b"".join(out) or payload
    coding = fields.get("content-encoding", "").lower()
    try:
        if coding in ("gzip", "x-gzip"):
            return gzip.decompress(payload)
        if coding == "deflate":
            return zlib.decompress(payload, zlib.MAX_WBITS if payload[:1] == b"\x78" else -zlib.MAX_WBITS)
    except (OSError, EOFError, zlib.error):
        return payload
    return payload


def charset(headers: str | None, data: bytes) -> str:
    """The charset of a page: its mark, its head's, its own, else UTF-8; names that Python does not know count as none."""
    told = _CHARSET.search(http_fields(headers).get("content-type", ""))
    own = _META.search(data[:META_BYTES])
    names = [name for mark, name in _MARKS if data.startswith(mark)] + [told.group(1) if told else "", own.group(1).decode() if own else ""]
    for name in names:
        try:
            if name:
                return codecs.lookup(name).name
        except LookupError:
            continue
    return "utf-8"


def _metadata(uri: str, page: str, data: bytes, encoding: str) -> str:
    """The fields of a metadata block: title, language, size and outlinks."""
    title, lang = _TITLE.search(page), _LANG.search(page)
    fields = [("title", " ".join(html_text.html.unescape(title.group(1)).split()) if title else ""), ("languages", html_text.attributes(lang.group(1)).get("lang", "") if lang else ""), ("charset", encoding), ("payload-bytes", str(len(data)))]
    for m in _HREF.finditer(page):
        if href := html_text.attributes(m.group(1)).get("href"):
            try:
                fields.append(("outlink", f"{urljoin(uri, href.strip())} L a/@href"))
            except ValueError:  # a reference that is no URL is kept as it stands
                fields.append(("outlink", f"{href.strip()} L a/@href"))
    return "".join(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}\r\n" for k, v in fields)


def derive(records: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """A metadata and a conversion record for each response record, linked by ``refers_to``; ``carry`` columns stay.

    Payloads are freed of the codings that their head names and read in their charset, with replacement characters where
    that fails; null payloads count as empty and give an empty conversion block. Whole payloads are converted. Null ids,
    targets, dates and heads are kept as nulls (a null target as an empty one); ids of derivatives follow from the
    response's id and digest all the same. Repeated responses give repeated derivatives with equal ids. An empty table
    gives none.
    """
    cols = [*carry, "record_id", "target_uri", "date", "http_headers", "payload_digest", "payload"]

    def run(frames):
        for f in frames:
            out = []
            for row in f[cols].itertuples(index=False, name=None):
                kept, (rid, uri, date, headers, own, payload) = row[: len(carry)], row[len(carry) :]
                payload = bytes(payload) if payload is not None else b""
                own, data, uri = own or digest(payload), body(headers, payload), uri or ""
                encoding = charset(headers, data)
                page = data.decode(encoding, "replace")
                for kind, mime, block in (("metadata", "application/warc-fields", _metadata(uri, page, data, encoding)), ("conversion", "text/plain; charset=utf-8", html_text.plain_text(page))):
                    data = block.encode("utf-8", "replace")
                    out.append((*kept, kind, record_id(kind, rid or "", own), rid, uri, date, mime, headers, own, digest(data), len(data), data.decode()))
            yield pd.DataFrame(out, columns=[*carry, *(x.split()[0] for x in DERIVED.split(", "))])

    kept = "".join(f"{c} {t}, " for c, t in records.select(*carry).dtypes) if carry else ""
    return records.select(*cols).mapInPandas(run, kept + DERIVED)


def serialize(row) -> bytes:
    """One derivative record as the bytes of a WARC file."""
    block = (row["block"] or "").encode()
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Refers-To", row["refers_to"]), ("WARC-Target-URI", row["target_uri"]), ("WARC-Date", row["date"]), ("WARC-Block-Digest", row["block_digest"]), ("WARC-Source-Payload-Digest", row["source_payload_digest"])]
    head += [("WARC-Source-Header", x) for x in (row["source_headers"] or "").split("\r\n") if x]
    head += [("Content-Type", row["content_type"]), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head if v is not None) + "\r\n").encode() + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Header fields and block of each record of a WARC file, gzipped or not.

    Field names keep their case; white space around values does not matter. A record without a length, or cut short, is
    passed over up to the next record's first line; bytes that are no record at all raise a ValueError.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        end = data.find(b"\r\n\r\n", at)
        lines = data[at : end if end >= 0 else len(data)].decode("utf-8", "replace").split("\r\n")[1:]
        head = [(name.strip(), value.strip()) for name, colon, value in (x.partition(":") for x in lines) if colon]
        size = next((v for k, v in head if k.lower() == "content-length"), "")
        stop = end + 4 + int(size) if end >= 0 and size.isdigit() else -1
        if 0 <= stop <= len(data):
            yield head, data[end + 4 : stop]
            at = stop
            while data.startswith(b"\r\n", at):
                at += 2
        else:
            following = data.find(b"\r\n\r\nWARC/", at + 1)
            at = following + 4 if following >= 0 else len(data)


def serialize_response(row) -> bytes:
    """One response record, as ``responses`` gives it, as the bytes of a WARC file."""
    block = row["http_headers"].encode() + bytes(row["payload"])
    head = [("WARC-Type", "response"), ("WARC-Record-ID", row["record_id"]), ("WARC-Target-URI", row["target_uri"]), ("WARC-Date", row["date"]), ("WARC-Payload-Digest", row["payload_digest"]), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def read_responses(spark: SparkSession, path: str, files: str = "*.warc*") -> DataFrame:
    """The response records of WARC files, gzipped or not, in any store that Spark reads; a task has one file at a time.

    The HTTP head and the payload are taken apart at the first empty line; a payload digest that the record does not
    carry is computed. Records of other types are passed over, and so are broken ones; a file that is no WARC file gives
    no rows. A file is unpacked in one task, so files should be of the usual 1 GB at most.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", files).option("recursiveFileLookup", "true").load(path).select("content")

    def run(frames):
        for f in frames:
            for content in f["content"]:
                out = []
                try:
                    for head, block in parse_records(bytes(content)):
                        fields = {k.lower(): v for k, v in head}
                        if fields.get("warc-type") != "response":
                            continue
                        http, gap, payload = block.partition(b"\r\n\r\n")
                        out.append((fields.get("warc-record-id"), fields.get("warc-target-uri", ""), fields.get("warc-date"), (http + gap).decode("latin-1"), fields.get("warc-payload-digest") or digest(payload), payload))
                except (ValueError, OSError, EOFError, zlib.error):
                    pass  # what came before the broken part is kept
                yield pd.DataFrame(out, columns=[x.split()[0] for x in RESPONSE.split(", ")])

    return found.mapInPandas(run, RESPONSE)


def write_files(derived: DataFrame, path: str) -> None:
    """Each record as a gzip member in a binary column of Parquet files under ``path``, ready to be concatenated."""

    @F.pandas_udf("binary")
    def member(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([gzip.compress(serialize(r), 6, mtime=0) for r in rows.to_dict("records")], dtype=object)

    cols = [x.split()[0] for x in DERIVED.split(", ")]
    derived.select("record_id", "record_type", member(F.struct(*cols)).alias("member")).write.mode("overwrite").parquet(path)


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of all pages, taken as responses."""
    made = derive(responses(common.table(spark, sf_dir, "pages")), ("key",))
    return made.select(F.col("key").cast("long").alias("page_id"), *(x.split()[0] for x in DERIVED.split(", ")))
