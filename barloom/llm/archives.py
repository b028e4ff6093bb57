"""Archive formats: ARC versions 1 and 2 in, WARC 1.1 out, and reading WARC back.

Pure functions over bytes and streams; `warc.py` runs them in Spark tasks.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from typing import BinaryIO
from urllib.parse import quote

# Fixed values of the formats: the field names of ARC header lines by version.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL",
        "IP-address",
        "Archive-date",
        "Content-type",
        "Result-code",
        "Checksum",
        "Location",
        "Offset",
        "Filename",
        "Archive-length",
    ],
}
ARC_TIME = "%Y%m%d%H%M%S"
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_CAPTURE = datetime(1996, 1, 1, tzinfo=timezone.utc)
ID_HEADER = "X-Page-Id"
ABSENT = "-"


@dataclass
class ArcRecord:
    version: int
    fields: dict[str, str]
    content: bytes
    opens: bool = False  # the version block, known by its place, as any URL may be a page's


@dataclass
class WarcRecord:
    headers: dict[str, str]
    block: bytes = b""
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def _printable(url: str | None) -> str:
    """A URL without blanks or control characters, as one field of a header line."""
    return quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else ABSENT


def capture_time(page_id: int | None) -> datetime:
    """A page table has no times: one second per id, within ten years."""
    return FIRST_CAPTURE + timedelta(seconds=(page_id or 0) % (10 * 365 * 86400))


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 barloom\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    head = f"filedesc://{name} 0.0.0.0 {FIRST_CAPTURE:{ARC_TIME}} text/plain"
    if version == 2:
        head += f" 200 - - 0 {name}"
    return f"{head} {len(body)}\n".encode() + body + b"\n"


def arc_record(
    version: int, name: str, offset: int, page_id: int | None, url: str | None, payload: bytes
) -> bytes:
    http = "HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if page_id is not None:
        http += f"{ID_HEADER}: {page_id}\r\n"
    content = f"{http}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    line = f"{_printable(url)} 0.0.0.0 {capture_time(page_id):{ARC_TIME}} text/html"
    if version == 2:
        line += f" 200 {hashlib.md5(payload).hexdigest()} - {offset} {name}"
    return f"{line} {len(content)}\n".encode() + content + b"\n"


def read_arc(stream: BinaryIO) -> Iterator[ArcRecord]:
    """Records of an ARC file, the version block first.

    The version block declares the version; its fields settle how the following
    header lines are read. Contents are taken by declared length only.
    """
    version = 0
    while line := stream.readline():
        if not line.strip():
            continue
        values = line.decode().split()
        fields = ARC_FIELDS.get(version) or ARC_FIELDS[1 if len(values) == 5 else 2]
        if len(values) != len(fields):
            raise ValueError(f"ARC header line with {len(values)} of {len(fields)} fields: {line[:80]!r}")
        length = int(values[-1])
        content = stream.read(length)
        if len(content) != length:
            raise ValueError(f"ARC record ends after {len(content)} of {length} bytes")
        opens = not version
        if opens:
            if not values[0].startswith("filedesc://"):
                raise ValueError("an ARC file starts with its version block")
            version = int(content.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version}")
            if content.decode().splitlines()[1].split() != ARC_FIELDS[version]:
                raise ValueError("the version block declares other fields")
        yield ArcRecord(version, dict(zip(fields, values, strict=True)), content, opens)


def record_id(page_id: int | None, fallback: bytes = b"") -> str:
    """A version 8 UUID: a page's 64-bit id and 48 bits derived from it.

    The id can be read back (`page_of`), so a reference needs no lookup. Without a
    page id the bits come from `fallback`, and a flag says so.
    """
    if page_id is None:
        digest = int.from_bytes(hashlib.sha1(fallback).digest()[:14], "big")
        high, low, flag = digest >> 64 & (1 << 48) - 1, digest & (1 << 64) - 1, 1
    else:
        low, flag = page_id & (1 << 64) - 1, 0
        high = int.from_bytes(hashlib.sha1(b"page %d" % page_id).digest()[:6], "big")
    middle = flag << 11 | low >> 62
    number = high << 80 | 8 << 76 | middle << 64 | 2 << 62 | low & (1 << 62) - 1
    return f"<urn:uuid:{uuid.UUID(int=number)}>"


def page_of(identifier: str) -> int | None:
    number = uuid.UUID(identifier.strip("<>").removeprefix("urn:uuid:")).int
    middle = number >> 64 & 0xFFF
    if middle >> 11:
        return None
    low = (middle & 3) << 62 | number & (1 << 62) - 1
    return low - (1 << 64) if low >> 63 else low


def payload_digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digest_hex(value: str) -> str:
    return base64.b32decode(value.removeprefix("sha1:")).hex()


def split_http(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Head with its blank line, header fields, body."""
    end = block.index(b"\r\n\r\n") + 4
    lines = block[:end].decode("latin-1").split("\r\n")[1:]
    pairs = (line.split(":", 1) for line in lines if ":" in line)
    return block[:end], {k.strip(): v.strip() for k, v in pairs}, block[end:]


def convert(record: ArcRecord, refers_to: int | None = None) -> WarcRecord:
    """The WARC record for an ARC record: a response, or a revisit of page `refers_to`.

    Synthesised: identifier, ISO time, type, payload and block digests. Version 2's
    checksum is verified. The version block becomes the warcinfo record.
    """
    when = datetime.strptime(record.fields["Archive-date"], ARC_TIME).replace(tzinfo=timezone.utc)
    headers = {"WARC-Date": f"{when:%Y-%m-%dT%H:%M:%SZ}"}
    url = record.fields["URL"]
    if record.opens:
        block = f"software: barloom\r\nformat: {WARC_VERSION}\r\nconverted-from: ARC/{record.version}\r\n"
        return WarcRecord(
            {
                "WARC-Type": "warcinfo",
                "WARC-Record-ID": record_id(None, url.encode()),
                **headers,
                "WARC-Filename": url.removeprefix("filedesc://"),
                "Content-Type": "application/warc-fields",
            },
            block.encode(),
        )
    head, http, payload = split_http(record.content)
    checksum = record.fields.get("Checksum", ABSENT)
    if checksum != ABSENT and checksum != hashlib.md5(payload).hexdigest():
        raise ValueError(f"checksum of {url} differs")
    page_id = int(http[ID_HEADER]) if ID_HEADER in http else None
    block = record.content if refers_to is None else head
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, url.encode() + record.content),
        **headers,
        "WARC-Payload-Digest": payload_digest(payload),
        "WARC-Block-Digest": payload_digest(block),
        "Content-Type": "application/http; msgtype=response",
    }
    if url != ABSENT:
        headers["WARC-Target-URI"] = url
    if refers_to is not None:
        headers["WARC-Profile"] = REVISIT_PROFILE
        headers["WARC-Refers-To"] = record_id(refers_to)
    return WarcRecord(headers, block)


def warc_bytes(record: WarcRecord, level: int = 6) -> bytes:
    """One gzip member per record, so that a reader may start at any record."""
    head = [WARC_VERSION, *(f"{k}: {v}" for k, v in record.headers.items())]
    head += [f"Content-Length: {len(record.block)}", "", ""]
    plain = "\r\n".join(head).encode() + record.block + b"\r\n\r\n"
    return gzip.compress(plain, compresslevel=level, mtime=0)


def read_warc(stream: BinaryIO) -> Iterator[WarcRecord]:
    """Records of a gzipped WARC file; digests are verified."""
    plain = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
    while line := plain.readline():
        if line.strip() != WARC_VERSION.encode():
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := plain.readline().decode().rstrip("\r\n")) != "":
            name, value = line.split(":", 1)
            headers[name] = value.strip()
        length = int(headers["Content-Length"])
        block = plain.read(length)
        if len(block) != length or plain.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('WARC-Record-ID')} is cut short")
        record = WarcRecord(headers, block)
        if headers["WARC-Type"] in ("response", "revisit"):
            _, record.http, record.payload = split_http(block)
            if payload_digest(block) != headers["WARC-Block-Digest"]:
                raise ValueError(f"block digest of {headers['WARC-Record-ID']} differs")
            if (
                headers["WARC-Type"] == "response"
                and payload_digest(record.payload) != headers["WARC-Payload-Digest"]
            ):
                raise ValueError(f"payload digest of {headers['WARC-Record-ID']} differs")
        yield record
