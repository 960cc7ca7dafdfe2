"""Operator 7: secrets in whole texts, with structural confirmation.

Three patterns find assignments, access keys and hexadecimal strings; these base spans
are always reported.  Beside them, long base64 and hexadecimal candidates are decoded and
reported only if their structure holds: a DER sequence whose nested lengths add up to a
private key, an OpenSSH private key with its length-prefixed fields, a PEM block whose
body decodes to one of them (or, under headers that say it is encrypted, to whole cipher
blocks), a signed token whose header and claims are JSON.  A key's encoding may be wrapped
over lines, and a whole PEM text encoded once more.

NULL and empty texts hold none.  Spans are in code points, end exclusive; overlapping
spans of different kinds are all reported, ties by the order of ``KINDS``.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

from pyspark.sql import DataFrame

from sparkmart.llm.common import map_texts

KINDS = ("assign", "access", "hex", "pem", "der", "openssh", "token")
#: The base patterns.  Letters of the first are ASCII in either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE, MIN_ACCESS = 6, 20
_NAMES = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)

_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:\s*(?:[\r\n]|\\n)\s*[A-Za-z0-9-]+:[^\r\n\\]*)*)([A-Za-z0-9+/=\s\\]*)-----END \1-----")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_ANY_HEX = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{2}){32,}(?![0-9A-Za-z])")
#: Lines of base64 or hexadecimal digits, one after the other; the last one may be short.
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{40,}[ \t\r]*\n[ \t]*)+[A-Za-z0-9+/_-]+(?![A-Za-z0-9+/_-])={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_NO_HEX = re.compile(r"[^0-9a-fA-F]")
#: A JSON object begins with a brace or white space.
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([eICD][A-Za-z0-9_-]{9,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
_SSH_MAGIC = b"openssh-key-v1\x00"

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the three base patterns."""
    found: list[Span] = []
    if (":" in text or "=" in text) and _NAMES.search(text):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def _decode(text: str) -> bytes | None:
    body = re.sub(r"[\s=]|\\[nr]", "", text).translate({ord("-"): "+", ord("_"): "/"})
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER values that fill ``data`` exactly, or None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


def is_private_der(data: bytes) -> bool:
    """A PKCS#1, PKCS#8, SEC1 or encrypted PKCS#8 private key: one sequence, nested lengths exact."""
    outer = _der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = _der_items(outer[0][1])
    if not inner:
        return False
    tags = [tag for tag, _ in inner]
    if tags == [0x30, 0x04]:  # encrypted: algorithm, data
        algorithm = _der_items(inner[0][1])
        return bool(algorithm) and algorithm[0][0] == 0x06
    if tags[0] != 0x02 or len(inner[0][1]) != 1 or len(tags) < 3:
        return False
    if tags[1] == 0x30 and tags[2] == 0x04:  # version, algorithm, key
        algorithm = _der_items(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06
    if tags[1] == 0x04:  # elliptic curve: version 1, key
        return inner[0][1] == b"\x01" and len(inner[1][1]) >= 16
    return len(tags) >= 6 and all(tag == 0x02 for tag in tags[:6]) and len(inner[1][1]) >= 32


def is_openssh(data: bytes, at: int = 0) -> bool:
    """An OpenSSH private key from ``at`` on: magic, then cipher, derivation and its options as length-prefixed fields."""
    if not data.startswith(_SSH_MAGIC, at):
        return False
    at += len(_SSH_MAGIC)
    for _ in range(3):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        at += 4 + size
    return 1 <= int.from_bytes(data[at : at + 4], "big") <= 64


def _kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "openssh" if is_openssh(data) else "der" if data[0] == 0x30 and is_private_der(data) else None


def _pem_holds(m: re.Match) -> bool:
    """Whether the body of a PEM block is a private key; encrypted under its headers, whole cipher blocks."""
    data = _decode(m[3])
    if "Proc-Type" in m[2] and "ENCRYPTED" in m[2] and "DEK-Info" in m[2]:
        return bool(data) and len(data) % 8 == 0
    return _kind(data) is not None


def _decoded_kind(data: bytes | None) -> str | None:
    """The kind of decoded bytes: a key, or a PEM text that holds one."""
    if data and b"-----BEGIN " in data and any(_pem_holds(m) for m in _PEM.finditer(data.decode("latin-1"))):
        return "pem"
    return _kind(data)


def _unhex(text: str) -> bytes | None:
    try:
        return bytes.fromhex(text)
    except ValueError:
        return None


def _der_size(head: bytes) -> int:
    """Bytes of the DER sequence that begins with ``head``; 0 if none does."""
    if len(head) < 6 or head[0] != 0x30:
        return 0
    n = head[1] & 0x7F if head[1] & 0x80 else 0
    return 0 if n > 4 or head[1] == 0x80 else 2 + n + (int.from_bytes(head[2 : 2 + n], "big") if n else head[1])


def _ssh_size(data: bytes, at: int) -> int:
    """Bytes of the OpenSSH key that begins at ``at``: three fields, public keys, the private part; 0 if they go beyond the data."""
    begin, at = at, at + len(_SSH_MAGIC)
    for _ in range(3):
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    many = int.from_bytes(data[at : at + 4], "big")
    at += 4
    for _ in range(many + 1 if 1 <= many <= 64 else 0):
        if at + 4 > len(data):
            return 0
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at - begin if 1 <= many <= 64 and at <= len(data) else 0


class _Decoded:
    """Lines of digits, decoded once for each of the places at which a byte can begin."""

    def __init__(self, whole: str, decode, chars: int, size: int):
        self.whole, self.decode, self.chars, self.size = whole, decode, chars, size
        self.known: dict[int, bytes] = {}

    def from_(self, at: int) -> tuple[bytes, int]:
        """Decoded bytes, and where in them what the digit ``at`` begins stands; what is no digit counts as zero."""
        phase = at % self.chars
        if phase not in self.known:
            rest = self.whole[phase:] if self.decode is _decode else _NO_HEX.sub("0", self.whole[phase:])
            self.known[phase] = self.decode(rest[: len(rest) - (len(rest) % self.chars == 1)]) or b""
        return self.known[phase], (at - phase) // self.chars * self.size


def _wrapped_spans(text: str) -> list[Span]:
    """Keys whose encoding goes on over several lines.

    A line at which one can begin tells its size (DER, OpenSSH) or goes on to the end of the
    lines; a last line that is a word of the text after it is tried without.  A block is
    decoded once for all its lines, and a PEM text in it is looked for at the first line only of
    each place at which a byte can begin: later lines hold no more of it.
    """
    found: list[Span] = []
    for block in _LINES.finditer(text):
        lines = list(_LINE.finditer(text, block.start(), block.end()))
        parts = [m[0].rstrip("=") for m in lines]
        whole, starts = "".join(parts), [0]
        for part in parts:
            starts.append(starts[-1] + len(part))
        line_at = {at: k for k, at in enumerate(starts)}
        ways = [(_Decoded(whole, _decode, 4, 3), 4 / 3), (_Decoded(whole, _unhex, 2, 1), 2)]
        tried: set[tuple[int, int]] = set()
        done = 0
        for i, at in enumerate(starts[:-2]):
            if i < done:
                continue
            for way, (decoded, chars) in enumerate(ways):
                head = decoded.decode(whole[at : at + 20]) or b""
                size, ends = _der_size(head), []
                if head.startswith(_SSH_MAGIC[:10]):
                    size = _ssh_size(*decoded.from_(at))
                    ends = [len(lines)] if is_openssh(*decoded.from_(at)) else []
                if size:
                    end = at - int(-size * chars // 1)
                    ends = [line_at[end]] if end in line_at else []
                elif head.startswith(b"-----BEGIN"):
                    ends = [] if (way, at % decoded.chars) in tried else [len(lines) - 1, len(lines)]
                    tried.add((way, at % decoded.chars))
                kinds = ((end, _decoded_kind(decoded.decode(whole[at : starts[end]]))) for end in ends if end > i)
                end, kind = next(((end, kind) for end, kind in kinds if kind), (0, None))
                if kind:
                    # a single line is a candidate of its own
                    found += [(kind, lines[i].start(), lines[end - 1].end())] if end > i + 1 else []
                    done = end
                    break
    return found


def _object(part: str) -> dict | None:
    try:
        value = json.loads(_decode(part) or b"")
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def confirmed_spans(text: str) -> list[Span]:
    """Candidates whose decoded structure is that of a private key or a signed token."""
    found: list[Span] = []
    if "-----BEGIN " in text:
        found += [("pem", m.start(), m.end()) for m in _PEM.finditer(text) if _pem_holds(m)]
    if "." in text:
        for m in _TOKEN.finditer(text):
            header = _object(m[1])
            if header and isinstance(header.get("alg"), str) and ("enc" in header or _object(m[2]) is not None):
                found.append(("token", m.start(), m.end()))
    blocks = [(a, b) for kind, a, b in found if kind == "pem"]
    outside = lambda at: not any(a <= at < b for a, b in blocks)
    over = [x for x in _wrapped_spans(text) if outside(x[1])]
    blocks += [(a, b) for _, a, b in over]
    found += over
    for pattern, decode in ((_BASE64, _decode), (_ANY_HEX, bytes.fromhex)):
        for m in pattern.finditer(text):
            kind = _decoded_kind(decode(m[0]))
            if kind and outside(m.start()):
                found.append((kind, m.start(), m.end()))
    return found


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(text: str) -> list[Span]:
    """All spans of a text, by start, then kind as listed."""
    return ordered(base_spans(text) + confirmed_spans(text))


def masked(text: str) -> str:
    """The text with every found secret replaced by a marker; of an assignment its value only."""
    out, at = [], 0
    for kind, start, end in scan(text):
        if kind == "assign":
            start = ASSIGN.match(text, start).start(2)
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def join_spans(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan_documents(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans and all spans, per row.  No shuffle."""

    def rows(keys, texts):
        for key, text in zip(keys, texts, strict=True):
            base = ordered(base_spans(text))
            kinds = [kind for kind, _, _ in base]
            digest = hashlib.sha256(join_spans(base).encode()).hexdigest()
            yield key, *(kinds.count(k) for k in KINDS[:3]), digest, join_spans(ordered(base + confirmed_spans(text)))

    return map_texts(docs, rows, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
