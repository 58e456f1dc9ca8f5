"""Records of web archives as bytes: writing with segments and chunks, and reading."""

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

END = b"\r\n\r\n"
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")


def headers(lines: dict[str, str], first: str) -> bytes:
    """A block of named fields after a first line, with the empty line that ends it.

    Control characters in a value, line breaks among them, are written as in addresses: ``%0A``.
    """
    safe = {k: _CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", v) for k, v in lines.items()}
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in safe.items()), "", ""]).encode()


def read_headers(data: bytes, start: int) -> tuple[str, dict[str, str], int]:
    """First line, fields by lower-case name, and where the block after them begins."""
    end = data.index(END, start)
    first, *lines = data[start:end].decode("utf-8").split("\r\n")
    fields = (line.partition(":") for line in lines)
    return first, {k.strip().lower(): v.strip() for k, _, v in fields}, end + len(END)


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of chunked transfer framing; extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        parts.append(body[end + 2:end + 2 + size])
        if len(parts[-1]) != size or body[end + 2 + size:end + 4 + size] != b"\r\n":
            raise ValueError("A chunk is cut off")
        at = end + 4 + size


def digest(payload: bytes) -> str:
    """Lower-case hexadecimal SHA-1."""
    return hashlib.sha1(payload).hexdigest()


def _labelled(hexadecimal: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def bare(label: str) -> str:
    """The hexadecimal form of a digest field."""
    return base64.b32decode(label.partition(":")[2]).hex()


def written(
    record_id: str, uri: str, payload: bytes, refers_to: str | None, chunk: int, segment: int
) -> Iterator[bytes]:
    """The records of one page without the two line ends after each.

    A revisit has the headers of its response and no payload.  A response longer than
    ``segment`` bytes is cut; its parts are continuations that name the first.
    """
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": record_id,
        "WARC-Target-URI": uri, "WARC-Date": "2024-01-01T00:00:00Z",
        "WARC-Payload-Digest": _labelled(digest(payload)), "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        fields["WARC-Refers-To"] = refers_to
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        block = headers({"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))}, "HTTP/1.1 200 OK")
        yield headers(fields | {"Content-Length": str(len(block))}, "WARC/1.1") + block
        return
    kind = {"Content-Type": "text/html; charset=utf-8", "Transfer-Encoding": "chunked"}
    block = headers(kind, "HTTP/1.1 200 OK") + chunked(payload, chunk)
    parts = [block[i:i + segment] for i in range(0, len(block), segment)]
    for number, part in enumerate(parts, 1):
        own = dict(fields)
        if len(parts) > 1:
            own["WARC-Segment-Number"] = str(number)
        if number > 1:
            own = {
                "WARC-Type": "continuation", "WARC-Record-ID": f"{record_id[:-1]}/segment/{number}>",
                "WARC-Target-URI": uri, "WARC-Date": fields["WARC-Date"],
                "WARC-Segment-Origin-ID": record_id, "WARC-Segment-Number": str(number),
            }
            if number == len(parts):
                own["WARC-Segment-Total-Length"] = str(len(block))
        yield headers(own | {"Content-Length": str(len(part))}, "WARC/1.1") + part


@dataclass(frozen=True)
class Record:
    """One record of an archive; ``total`` is known from the last segment."""

    fields: dict[str, str]
    block: bytes

    @property
    def origin(self) -> str:
        return self.fields.get("warc-segment-origin-id") or self.fields["warc-record-id"]

    @property
    def segment(self) -> int | None:
        number = self.fields.get("warc-segment-number")
        return int(number) if number else None

    @property
    def total(self) -> int | None:
        total = self.fields.get("warc-segment-total-length")
        return int(total) if total else None


def records(data: bytes) -> Iterator[Record]:
    """The records of an uncompressed archive, in order."""
    at = 0
    while at < len(data):
        first, fields, start = read_headers(data, at)
        if not first.startswith("WARC/"):
            raise ValueError(f"No record begins at byte {at}")
        end = start + int(fields["content-length"])
        if data[end:end + 4] != END:
            raise ValueError(f"The record at byte {at} is cut off")
        yield Record(fields, data[start:end])
        at = end + 4


def http_payload(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of an HTTP response."""
    _, fields, start = read_headers(block, 0)
    body = block[start:]
    return fields, unchunked(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body
