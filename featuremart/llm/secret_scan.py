r"""Secret scans with structural confirmation.

Patterns find assignments of secrets, access keys and long hex strings (the base kinds). Beside them,
candidates in base64 or hex are decoded and reported only if what they hold is whole:

- ``key``: a private key. DER is walked by its nested lengths, each of which has to fill its parent: PKCS#1,
  SEC 1 and DSA keys, PKCS#8 and its encrypted form. The OpenSSH form is walked by its length fields.
  Base64 may be broken into lines, by line ends or by a written ``\n``. The structure says where the key
  ends, and the encoding has to end there.
- ``jwt``: a signed token. The header is a JSON object that names an algorithm, the payload is one too, and
  the signature has a length that the algorithm makes.

Cases: null or empty text has no spans; spans are in code points, the end exclusive, ordered by start, then
by kind as in :data:`KINDS`; repeated rows get equal answers; a text is scanned whole in one task, in
memory.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as tx

KINDS = ("assign", "access", "hex", "key", "jwt")
BASE = KINDS[:3]
#: Shorter texts in any case precede an assignment.
_HINTS = ("passw", "secret", "token", "api")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

# A JSON object's brace, a DER sequence and OpenSSH's first word, as they begin in base64 or hex.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(e[w-z0-9_-][A-Za-z0-9_-]{6,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
_B64 = re.compile(r"(?<![A-Za-z0-9+/])(?:M[A-P]|b3BlbnNzaC1rZXktdjEA)[A-Za-z0-9+/]{14}")
_RUN = re.compile(r"[A-Za-z0-9+/]+")
_BREAK = re.compile(r"\r?\n|(?:\\r)?\\n")
_HEXED = re.compile(r"(?<![0-9A-Fa-f])(?:30|6f70656e7373682d6b65792d763100|6F70656E7373682D6B65792D763100)(?:[0-9A-Fa-f]{2}){15,}(?![0-9A-Fa-f])")
_OPENSSH = b"openssh-key-v1\0"

# Bytes of a signature by algorithm (least and most).
SIGNATURES = {
    "none": (0, 0),
    "HS256": (32, 32),
    "HS384": (48, 48),
    "HS512": (64, 64),
    "ES256": (64, 64),
    "ES256K": (64, 64),
    "ES384": (96, 96),
    "ES512": (132, 132),
    "EdDSA": (64, 114),
    "RS256": (128, 2048),
    "RS384": (128, 2048),
    "RS512": (128, 2048),
    "PS256": (128, 2048),
    "PS384": (128, 2048),
    "PS512": (128, 2048),
}
# DER tags.
INTEGER, BITS, OCTETS, OID, SEQUENCE, TAG_0, TAG_1 = 0x02, 0x03, 0x04, 0x06, 0x30, 0xA0, 0xA1


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the DER element at ``at``, if it lies before ``end``."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size > 0x80:
        digits = size - 0x80
        if digits > 4 or start + digits > end or data[start] == 0:
            return None
        size = int.from_bytes(data[start : start + digits], "big")
        start += digits
        if size < 0x80:
            return None
    elif size == 0x80:
        return None
    return (tag, start, start + size) if start + size <= end else None


def _children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]]:
    """The elements that fill a span; none if they don't."""
    found = []
    while start < end:
        own = _element(data, start, end)
        if own is None:
            return []
        found.append(own)
        start = own[2]
    return found


def _algorithm(data: bytes, own: tuple[int, int, int]) -> bool:
    inner = _children(data, own[1], own[2]) if own[0] == SEQUENCE else []
    return bool(inner) and inner[0][0] == OID and inner[0][2] > inner[0][1]


def der_key(data: bytes) -> tuple[str, int] | None:
    """Form and length of the private key that ``data`` begins with."""
    whole = _element(data, 0, len(data))
    if whole is None or whole[0] != SEQUENCE:
        return None
    parts = _children(data, whole[1], whole[2])
    tags = [p[0] for p in parts]
    if not parts:
        return None
    number = int.from_bytes(data[parts[0][1] : parts[0][2]], "big") if tags[0] == INTEGER and parts[0][2] - parts[0][1] == 1 else None
    full = all(e > s for _, s, e in parts)
    if full and number == 0 and tags == [INTEGER] * 9 or full and number == 1 and tags == [INTEGER] * 9 + [SEQUENCE]:
        return "pkcs1", whole[2]
    if full and number == 0 and tags == [INTEGER] * 6:
        return "dsa", whole[2]
    if full and number == 1 and tags[1:2] == [OCTETS] and tags[2:] in ([], [TAG_0], [TAG_1], [TAG_0, TAG_1]):
        if all(_children(data, s, e) for t, s, e in parts[2:]):
            return "sec1", whole[2]
    if number in (0, 1) and tags[1:3] == [SEQUENCE, OCTETS] and all(t in (TAG_0, TAG_1, 0x81) for t in tags[3:]):
        if _algorithm(data, parts[1]) and _children(data, parts[2][1], parts[2][2]):
            return "pkcs8", whole[2]
    if tags == [SEQUENCE, OCTETS] and _algorithm(data, parts[0]) and full:
        return "pkcs8-encrypted", whole[2]
    return None


def openssh_key(data: bytes) -> tuple[str, int] | None:
    at = len(_OPENSSH)

    def number() -> int | None:
        nonlocal at
        at += 4
        return int.from_bytes(data[at - 4 : at], "big") if at <= len(data) else None

    def field() -> bytes | None:
        nonlocal at
        size = number()
        if size is None or at + size > len(data):
            return None
        at += size
        return data[at - size : at]

    cipher, kdf, options = field(), field(), field()
    if not cipher or not kdf or options is None:
        return None
    keys = number()
    if not keys or keys > 64 or not all(field() for _ in range(keys)) or not field():
        return None
    return "openssh", at


def private_key(data: bytes) -> tuple[str, int] | None:
    return openssh_key(data) if data.startswith(_OPENSSH) else der_key(data)


def _wanted(head: str) -> int:
    """Base64 characters of the structure that begins so; for OpenSSH's any number."""
    data = base64.b64decode(head)
    if data.startswith(_OPENSSH[: len(data)]):
        return 2**62
    digits = max(0, data[1] - 0x80)
    size = int.from_bytes(data[2 : 2 + digits], "big") if digits else data[1]
    return -(-(2 + digits + size) * 8 // 6) if digits <= 4 else 0


def _runs(text: str, at: int, wanted: int) -> list[tuple[int, int]]:
    """The lines of base64 from ``at`` on, up to the wanted number of characters."""
    found = []
    while wanted and (run := _RUN.match(text, at, at + wanted)):
        found.append(run.span())
        wanted -= run.end() - at
        line_end = _BREAK.match(text, run.end())
        if line_end is None:
            break
        at = line_end.end()
    return found


def _base64_keys(text: str) -> Iterator[tuple[int, int, str]]:
    at = 0
    while found := _B64.search(text, at):
        start, at = found.start(), found.start() + 1
        runs = _runs(text, start, _wanted(found.group()[:16]))
        code = "".join(text[a:b] for a, b in runs)
        left = len(code) % 4
        key = private_key(base64.b64decode(code[: len(code) - left if left == 1 else None] + ("=" * (4 - left) if left > 1 else "")))
        if key is None:
            continue
        wanted = -(-key[1] * 8 // 6)
        for a, b in runs:
            if wanted <= b - a:
                break
            wanted -= b - a
        end = a + wanted
        padded = re.match("={0,2}", text[end : end + 2]).end()
        if not re.match(r"[A-Za-z0-9+/]", text[end + padded : end + padded + 1]):
            yield start, end + padded, key[0]
            at = end


def _hex_keys(text: str) -> Iterator[tuple[int, int, str]]:
    for found in _HEXED.finditer(text):
        data = bytes.fromhex(found.group())
        key = private_key(data)
        if key and key[1] == len(data):
            yield found.start(), found.end(), key[0]


def _object(code: str) -> dict | None:
    if len(code) % 4 == 1:
        return None
    try:
        value = json.loads(base64.urlsafe_b64decode(code + "=" * (-len(code) % 4)))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _tokens(text: str) -> Iterator[tuple[int, int, str]]:
    for found in _JWT.finditer(text):
        head, body, signature = found.groups()
        header = _object(head)
        name = header.get("alg") if header else None
        if not isinstance(name, str) or name not in SIGNATURES or len(signature) % 4 == 1 or _object(body) is None:
            continue
        least, most = SIGNATURES[name]
        if least <= len(signature) * 3 // 4 <= most:
            yield found.start(), found.end(), name


def spans(text: str) -> list[tuple[str, int, int, str | None]]:
    """Kind, start, end and form of all secrets of a text, in order."""
    found = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [(0, *m.span(), None) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(1, *m.span(), None) for m in _ACCESS.finditer(text)]
    found += [(2, *m.span(), None) for m in _HEX.finditer(text)]
    found += [(3, *k) for k in _base64_keys(text)]
    found += [(3, *k) for k in _hex_keys(text)]
    found += [(4, *k) for k in _tokens(text)]
    found.sort(key=lambda x: (x[1], x[0], x[2]))
    return [(KINDS[k], a, b, form) for k, a, b, form in found]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("form", pa.string())])


def _scan(batches):
    for batch in batches:
        flat, edges = [], [0]
        for text in batch.column("text"):
            flat.extend(spans(text.as_py()))
            edges.append(len(flat))
        columns = zip(*flat, strict=True) if flat else ([], [], [], [])
        values = [pa.array(list(c), f.type) for c, f in zip(columns, _SPAN, strict=True)]
        found = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.StructArray.from_arrays(values, fields=list(_SPAN)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("dig"), found], ["id", "dig", "spans"])


def secret_spans(docs: DataFrame) -> DataFrame:
    """``id, dig, spans`` for each row of ``docs``: the spans of its secrets with their kind, and, for the
    confirmed ones, the form of the key or the token's algorithm."""
    return tx.keyed(docs).mapInArrow(_scan, "id long, dig long, spans array<struct<kind:string,start:long,end:long,form:string>>")
