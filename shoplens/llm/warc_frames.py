"""Zstandard WARC archives: frames, dictionary and records (no Spark in here).

An archive is a run of Zstandard frames. The first may be skippable, with
magic number ``DICTIONARY``, and holds the dictionary of all that follow,
itself compressed or not. Every other frame is one whole record; skippable
frames of other numbers are passed over.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import zstandard

#: Fixed numbers of the formats.
DICTIONARY = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME = 0xFD2FB528
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
MANDATORY = ("warc-record-id", "warc-date", "warc-type", "content-length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Size of a trained dictionary, and bytes of payload that it is trained on.
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20
SAMPLE_PIECE = 16 << 10

_NAME = re.compile(rb"[!#$%&'*+\-.^_`|~0-9A-Za-z]+")


class BadArchive(ValueError):
    """What an archive or a record breaks of its format."""


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def u32(data: memoryview, at: int) -> int:
    if at + 4 > len(data):
        raise BadArchive("archive ends inside a frame")
    return int.from_bytes(data[at:at + 4], "little")


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame at ``at`` ends, from its header and block headers."""
    try:
        head = zstandard.get_frame_parameters(data[at:at + 18])
        at += zstandard.frame_header_size(data[at:at + 18])
    except zstandard.ZstdError as e:
        raise BadArchive(f"frame header: {e}") from e
    last = 0
    while not last:
        if at + 3 > len(data):
            raise BadArchive("archive ends inside a frame")
        block = int.from_bytes(data[at:at + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        if kind == 3:
            raise BadArchive("reserved block type")
        at += 3 + (1 if kind == 1 else size)
    at += 4 * head.has_checksum
    if at > len(data):
        raise BadArchive("archive ends inside a frame")
    return at


def _inflate(frame: memoryview, dictionary: zstandard.ZstdCompressionDict | None) -> bytes:
    out = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    try:
        data = out.decompress(frame)
    except zstandard.ZstdError as e:
        raise BadArchive(f"frame: {e}") from e
    if not out.eof or out.unused_data:
        raise BadArchive("frame length differs from its blocks")
    return data


def frames(archive: bytes) -> Iterator[tuple[int, bytes | BadArchive]]:
    """(offset, content) of every record frame; a frame that cannot be decoded gives its fault.

    A broken frame header or a cut end ends the archive: nothing after it can be found.
    """
    data, at, dictionary = memoryview(archive), 0, None
    while at < len(data):
        try:
            magic = u32(data, at)
            if magic in SKIPPABLE:
                end = at + 8 + u32(data, at + 4)
                if end > len(data):
                    raise BadArchive("archive ends inside a skippable frame")
                if magic == DICTIONARY and at == 0:
                    raw = bytes(data[8:end])
                    if raw[:4] == FRAME.to_bytes(4, "little"):
                        raw = _inflate(memoryview(raw), None)
                    dictionary = zstandard.ZstdCompressionDict(raw)
                at = end
                continue
            end = frame_end(data, at)
        except BadArchive as e:
            yield at, e
            return
        try:
            yield at, _inflate(data[at:end], dictionary)
        except BadArchive as e:
            yield at, e
        at = end


@dataclass
class Record:
    """A record; ``headers`` has lower-case names. ``payload`` is None where it is kept elsewhere (revisit)."""

    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes | None = None
    payload_bytes: int | None = None
    payload_digest: str | None = None


def _named_lines(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    name = ""
    for line in lines:
        if line[:1] in (b" ", b"\t") and name:                    # a folded line goes on
            out[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        key, colon, value = line.partition(b":")
        if not colon or not _NAME.fullmatch(key):
            raise BadArchive(f"header line {line[:40]!r}")
        name = key.decode().lower()
        out[name] = value.strip().decode("utf-8", "replace")
    return out


def _length(value: str, what: str) -> int:
    if not re.fullmatch("[0-9]{1,18}", value):
        raise BadArchive(f"{what} {value[:40]!r}")
    return int(value)


def parse_record(data: bytes) -> Record:
    """The record of a frame, its headers, lengths and digests checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in VERSIONS:
        raise BadArchive(f"record begins with {data[:20]!r}")
    headers = _named_lines(lines[1:])
    for name in MANDATORY:
        if not headers.get(name):
            raise BadArchive(f"no {name}")
    size = _length(headers["content-length"], "content-length")
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BadArchive(f"content-length {size}, block of {len(rest) - 4}")
    block = rest[:size]
    if (said := headers.get("warc-block-digest", "")).startswith("sha1:") and said[5:] != base32_sha1(block):
        raise BadArchive("block digest differs")
    record = Record(headers)
    body, claimed = block, None
    if headers.get("content-type", "").startswith("application/http"):
        http, gap, body = block.partition(b"\r\n\r\n")
        status, *fields = http.split(b"\r\n")
        if not gap or not status.startswith(b"HTTP/"):
            raise BadArchive("block is no HTTP message")
        names = _named_lines(fields)
        claimed = _length(names["content-length"], "HTTP content-length") if "content-length" in names else None
    digest = headers.get("warc-payload-digest", "")
    if headers["warc-type"] == "revisit":
        record.payload_bytes, record.payload_digest = claimed, digest.removeprefix("sha1:") or None
        if not headers.get("warc-refers-to"):
            raise BadArchive("revisit refers to nothing")
        return record
    if claimed is not None and claimed != len(body):
        raise BadArchive(f"HTTP content-length {claimed}, body of {len(body)}")
    record.payload, record.payload_bytes, record.payload_digest = body, len(body), base32_sha1(body)
    if digest.startswith("sha1:") and digest[5:] != record.payload_digest:
        raise BadArchive("payload digest differs")
    return record


def format_record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record's bytes; headers without a value are left out, control characters are percent-encoded."""
    lines = [b"WARC/1.1"]
    for name, value in [*headers, ("WARC-Block-Digest", "sha1:" + base32_sha1(block)), ("Content-Length", str(len(block)))]:
        if value:
            value = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value) if name.endswith("URI") else value
            lines.append(f"{name}: {value}".encode("utf-8", "replace"))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def http_response(payload_bytes: int, payload: bytes) -> bytes:
    """An HTTP message of a page whose whole payload has ``payload_bytes``."""
    return (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % payload_bytes
            + payload)


def train(payloads: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary for an archive, or None where there is too little to train on."""
    samples = [p[:SAMPLE_PIECE] for p in payloads if p]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples) if len(samples) >= 16 else None
    except zstandard.ZstdError:
        return None


class ArchiveFrames:
    """Turns records into an archive's frames, the dictionary's first."""

    def __init__(self, dictionary: zstandard.ZstdCompressionDict | None, level: int = 3) -> None:
        self._press = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
        self.head = b""
        if dictionary is not None:
            held = zstandard.ZstdCompressor(level=level).compress(dictionary.as_bytes())
            self.head = DICTIONARY.to_bytes(4, "little") + len(held).to_bytes(4, "little") + held

    def frame(self, record: bytes) -> bytes:
        return self._press.compress(record)
