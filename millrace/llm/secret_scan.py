"""Secret scan: patterns find candidates, their structure decides.

Patterns of assignments, access keys and hexadecimal runs are reported as they match.  Runs of
base64 or hexadecimal digits, armoured blocks and dotted tokens are only candidates: they are
decoded (base64 of an armoured block twice), and reported where the bytes parse as a key (nested lengths that fill the bytes
exactly) or the first part as the header of a signed token.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import narrow
from millrace.session import ship_package

#: Fixed by the contract: base patterns, least lengths, order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
BASE_KINDS = ("assign", "access", "hex")
#: Kinds that structure confirms.
KINDS = (*BASE_KINDS, "jwt", "pem", "der", "ssh")

HEX_RUN = re.compile(r"[0-9a-f]{24,}")
# A DER sequence starts with the byte 30, the SSH container with "o", a JSON object with "{"; each
# pattern starts with the digits of that, which the search skips to, and then looks back.
ENCODED = tuple(map(re.compile, (
    r"M(?<![A-Za-z0-9+/_-]M)[A-P][A-Za-z0-9+/_-]{30,}={0,2}",
    r"b3(?<![A-Za-z0-9+/_-]b3)[A-Za-z0-9+/_-]{30,}={0,2}",
)))
ENCODED_HEX = tuple(map(re.compile, (
    r"30(?:(?<![0-9A-Za-z]30)|(?<=(?<![0-9A-Za-z])0[xX]30))(?:[0-9a-f]{30,}|[0-9A-F]{30,})(?![0-9A-Za-z])",
    r"6[fF](?:(?<![0-9A-Za-z]6.)|(?<=(?<![0-9A-Za-z])0[xX]6.))(?:[0-9a-f]{30,}|[0-9A-F]{30,})(?![0-9A-Za-z])",
)))
DOTTED = re.compile(r"e(?<![A-Za-z0-9_.-]e)([A-Za-z0-9_-]{7,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
ARMOUR = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----([^-]*)-----END \1-----")

#: An armoured block that is encoded as a whole starts with the digits of "---".
ENCODED_ARMOUR = re.compile(r"LS0t(?<![A-Za-z0-9+/_-]LS0t)[A-Za-z0-9+/_-]{30,}={0,2}")
#: Line ends and slashes as JSON, shells and .env files write them.
#: A run of backslashes is taken whole and from its beginning, or a long one would be tried from each of its places.
ESCAPED = re.compile(r"(?<!\\)\\++(?:(?:(?:r|u000[dD])\\++)?(?:n|u000[aA])|[rt]|u000[dD9])")
ESCAPED_PLAIN = re.compile(r"(?<!\\)\\++(?=[/\s])")

SPAN_TYPE = "array<struct<kind:string,start:int,end:int,confirmed:boolean>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("confirmed", pa.bool_())]))

Span = tuple[str, int, int, bool]


def decode_base64(text: str) -> bytes | None:
    """Both alphabets, with or without padding; None where the digits cannot be decoded."""
    digits = re.sub(r"\s+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(digits + "=" * (-len(digits) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, value) of consecutive DER fields that fill ``data`` exactly."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size, at = int.from_bytes(data[at:at + width], "big"), at + width
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        found.append((tag, data[at:at + size]))
        at += size
    return found


def is_der_key(data: bytes | None) -> bool:
    """A private key: SEQUENCE with a version, then an integer (RSA, DSA), an octet string
    (EC), or an algorithm and an octet string (PKCS#8); or an encrypted PKCS#8 key."""
    outer = _fields(data) if data else None
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = _fields(outer[0][1])
    if not inner or len(inner) < 2:
        return False
    tags = [tag for tag, _ in inner]
    if tags[0] == 0x02 and inner[0][1] in (b"\x00", b"\x01"):
        if tags[1] == 0x02:
            return len(inner) in (6, 9, 10) and set(tags) <= {0x02, 0x30}
        if tags[1] == 0x04:
            return len(inner[1][1]) >= 16 and set(tags[2:]) <= {0xA0, 0xA1}
        return tags[1:3] == [0x30, 0x04] and _is_algorithm(inner[1][1])
    return tags == [0x30, 0x04] and _is_algorithm(inner[0][1])


def _is_algorithm(data: bytes) -> bool:
    fields = _fields(data)
    return bool(fields) and fields[0][0] == 0x06 and len(fields[0][1]) >= 3


def is_ssh_key(data: bytes | None) -> bool:
    """The container of private keys of SSH: magic, three strings, count, public parts, private part."""
    magic = b"openssh-key-v1\x00"
    if not data or not data.startswith(magic):
        return False
    at = len(magic)

    def string(at: int) -> int | None:
        if at + 4 > len(data):
            return None
        end = at + 4 + int.from_bytes(data[at:at + 4], "big")
        return end if end <= len(data) else None

    for _ in range(3):
        if (at := string(at)) is None:
            return False
    if at + 4 > len(data):
        return False
    n, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    if not 1 <= n <= 16:
        return False
    for _ in range(n + 1):
        if (at := string(at)) is None:
            return False
    return at == len(data)


def is_signed_token(header: str, claims: str) -> bool:
    """The first part is a JSON object that names an algorithm, the second any JSON object."""
    parts = []
    for part in (header, claims):
        try:
            parts.append(json.loads(decode_base64(part) or b""))
        except ValueError:
            return False
    return all(isinstance(part, dict) for part in parts) and isinstance(parts[0].get("alg"), str)


def key_kind(data: bytes | None) -> str | None:
    return "der" if is_der_key(data) else "ssh" if is_ssh_key(data) else None


def decode_hex(text: str) -> bytes | None:
    return bytes.fromhex(text) if len(text) % 2 == 0 else None


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # Runs are maximal, so asking for the least length at once finds the same ones.
    found += [("hex", *m.span()) for m in HEX_RUN.finditer(text)]
    return found


def is_armoured_key(body: str) -> bool:
    """Whether what stands between the lines of armour is a key, with true or escaped line ends."""
    plain = ESCAPED_PLAIN.sub("", ESCAPED.sub("\n", body))
    return any(key_kind(decode_base64(part)) for part in dict.fromkeys([plain.rpartition("\n\n")[2], plain]))


def structural_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("jwt", *m.span()) for m in DOTTED.finditer(text) if is_signed_token("e" + m.group(1), m.group(2))]
    found += [("pem", *m.span()) for m in ARMOUR.finditer(text) if is_armoured_key(m.group(2))]
    for m in ENCODED_ARMOUR.finditer(text):
        inner = (decode_base64(m.group()) or b"").decode("latin-1")
        if any(is_armoured_key(block.group(2)) for block in ARMOUR.finditer(inner)):
            found.append(("pem", *m.span()))
    for patterns, decode in ((ENCODED, decode_base64), (ENCODED_HEX, decode_hex)):
        for m in (m for pattern in patterns for m in pattern.finditer(text)):
            if kind := key_kind(decode(m.group())):
                found.append((kind, *m.span()))
    return found


def find_secrets(text: str) -> list[Span]:
    """All spans by start, then kind; confirmed if some structural span touches them."""
    base, structural = base_spans(text), list(dict.fromkeys(structural_spans(text)))
    spans = [(k, a, b, any(a < d and c < b for _, c, d in structural)) for k, a, b in base]
    spans += [(k, a, b, True) for k, a, b in structural]
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def scan_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: the id and ``spans`` in code points, ends exclusive.

    A null or empty text has no spans.  A null id stays null, repeated rows are scanned each for
    itself, an empty table gives an empty result, and no further column is read.  Whole texts are
    scanned, however long; a text is one value in one task.
    """
    ship_package(docs.sparkSession)
    chosen = narrow(docs, id_column, text_column)
    kind = chosen.schema[id_column].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b, "confirmed": c} for k, a, b, c in find_secrets(text or "")]
                for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], [id_column, "spans"])

    return chosen.mapInArrow(scan, f"`{id_column}` {kind}, spans {SPAN_TYPE}")
