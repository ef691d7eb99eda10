"""Secrets in texts: patterns for assignments, access keys and long hexadecimal runs, plus structurally confirmed keys and tokens.

A candidate of the second kind is reported only if it decodes and its structure holds:

* ``key``: a base64 or hexadecimal run, or the part of one after a separator or 0x, whose bytes are a private key, either DER (nested lengths that fill the whole, with the members of
  a PKCS#1, PKCS#8, encrypted PKCS#8 or SEC 1 key) or the OpenSSH container (every length-prefixed string ends inside the data); base64 may be wrapped into lines;
* ``pem``: a PEM block whose body is such a key, or by its headers an encrypted one of whole cipher blocks; line ends may be escaped, as in JSON;
* ``jwt``: a signed token, whose header and payload are base64url JSON objects and whose header names its algorithm.

Positions count code points, ends are exclusive.  A null text is empty.  Long texts are scanned whole, in linear time: lengths are checked before anything is decoded, and a key
has at most ``KEY_BYTES``.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame

from lakeops.llm.rows import with_function

Span = tuple[str, int, int]
KINDS = ("assign", "access", "hex", "key", "pem", "jwt")

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ENCODED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}(?![A-Za-z0-9+/=_-])")
KEY_START = re.compile(r"(?:(?<![A-Za-z0-9+])|(?<![A-Za-z0-9+])0[xX])(?=M[A-I]|b3BlbnNzaC1rZXktdjEA|30|6[fF]70656[eE])")
TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]{16,})(?![A-Za-z0-9_-])")
HEX_HEADER, HEX_ANY = re.compile("[0-9A-Fa-f]{12}"), re.compile("[0-9A-Fa-f]+")
PEM_EDGE = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
PEM_HEADERS = re.compile(r"\s*(?:[A-Za-z][A-Za-z-]*:\x20[^\n]*\n(?:[\x20\t][^\n]*\n)*)+\s*\n")
PEM_BODY = re.compile(r"[A-Za-z0-9+/]+={0,2}")
ESCAPED_BREAK = re.compile(r"(?:\\r)?\\n")
BREAK, LINE = re.compile(r"(?:\r?\n|(?:\\r)?\\n)[\x20\t]*"), re.compile(r"[A-Za-z0-9+/]+={0,2}")
KEY_BYTES = 1 << 14
OPENSSH = b"openssh-key-v1\x00"


def decoded(text: str, url_safe: bool = False) -> bytes | None:
    text = "".join(text.split())
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_" if url_safe else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the contents of each item in ``data[start:end]``, or None if the lengths don't fill it exactly."""
    items = []
    while start < end:
        if end - start < 2:
            return None
        tag, length = data[start], data[start + 1]
        start += 2
        if length & 0x80:
            n = length & 0x7F
            if not 1 <= n <= 4 or end - start < n:
                return None
            length = int.from_bytes(data[start : start + n], "big")
            start += n
        if length > end - start:
            return None
        items.append((tag, start, start + length))
        start += length
    return items


INTEGER, OCTETS, OBJECT_ID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_der_key(data: bytes) -> bool:
    outer = der_items(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    members = der_items(data, *outer[0][1:])
    tags = [m[0] for m in members or []]
    if len(tags) >= 9 and tags[:9] == [INTEGER] * 9:  # PKCS#1: version, n, e, d, p, q, ...
        return True
    if tags[:2] == [INTEGER, OCTETS] and data[members[0][1] : members[0][2]] == b"\x01":  # SEC 1
        return members[1][2] - members[1][1] >= 16
    at = 1 if tags[:3] == [INTEGER, SEQUENCE, OCTETS] else 0 if tags[:2] == [SEQUENCE, OCTETS] else None
    if at is None:
        return False
    algorithm = der_items(data, *members[at][1:])  # PKCS#8, plain or encrypted
    return bool(algorithm) and algorithm[0][0] == OBJECT_ID


def is_openssh_key(data: bytes) -> bool:
    if not data.startswith(OPENSSH):
        return False
    at, fields = len(OPENSSH), []

    def string() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return None
        value = data[at + 4 : at + 4 + n]
        at += 4 + n
        return value

    for _ in range(3):  # cipher, key derivation, its options
        fields.append(string())
    if None in fields or at + 4 > len(data):
        return False
    count = int.from_bytes(data[at : at + 4], "big")
    at += 4
    return 1 <= count <= 16 and all(string() is not None for _ in range(count + 1))  # public keys, then the private part


def is_private_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_openssh_key(data))


def is_pem_body(body: str) -> bool:
    """Whether what stands between the edges of a block is a key."""
    body = ESCAPED_BREAK.sub("\n", body)
    headers = PEM_HEADERS.match(body)
    if headers:
        body = body[headers.end() :]
    body = "".join(body.split())
    if not PEM_BODY.fullmatch(body):
        return False
    data = decoded(body)
    if headers and "ENCRYPTED" in headers[0] and "DEK-Info" in headers[0]:
        return data is not None and len(data) >= 64 and len(data) % 8 == 0
    return is_private_key(data)


def openssh_length(run: str, at: int, end: int, url_safe: bool) -> int:
    """Bytes of the OpenSSH container that starts at ``at``, by its length fields; 0 if they do not stay inside ``run[at:end]`` or ``KEY_BYTES``."""
    there = min((end - at) * 3 // 4, KEY_BYTES)
    place = len(OPENSSH)

    def number() -> int | None:
        nonlocal place
        if place + 4 > there:
            return None
        first = place // 3
        some = decoded(run[at + first * 4 : at + (place + 6) // 3 * 4], url_safe)
        place += 4
        return None if some is None else int.from_bytes(some[place - 4 - first * 3 : place - first * 3], "big")

    def skip() -> bool:
        nonlocal place
        n = number()
        if n is None or place + n > there:
            return False
        place += n
        return True

    if not (skip() and skip() and skip()):
        return 0
    count = number()
    return place if count is not None and 1 <= count <= 16 and all(skip() for _ in range(count + 1)) else 0


def openssh_fields(run: str, end: int) -> bool:
    """Whether the container's cipher, key derivation and options stand at its start and a possible number of keys follows."""
    data, at = decoded(run[: min(end, 512) // 4 * 4]) or b"", len(OPENSSH)
    for _ in range(3):
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 16


def wrapped_lines(text: str, start: int, need: int) -> list[tuple[str, int]]:
    """Lines of base64 from ``start`` on, each with its end, until they have ``need`` characters."""
    parts, at, got = [], start, 0
    while got < need and (m := LINE.match(text, at)):
        parts.append((m[0], m.end()))
        got += len(m[0])
        more = BREAK.match(text, m.end())
        if not more or m[0].endswith("="):
            break
        at = more.end()
    return parts


def wrapped_key(text: str, start: int) -> int | None:
    """The end of a key whose base64 starts here and goes on over several lines."""
    head = decoded(text[start : start + 16]) or b""
    ssh = text.startswith("b3BlbnNzaC1rZXktdjEA", start)
    size = KEY_BYTES if ssh else der_length(head)
    if ssh and (first := wrapped_lines(text, start, 256)) and not openssh_fields(few := "".join(line for line, _ in first), len(few.rstrip("="))):
        return None
    body = head[2 + (head[1] & 0x7F if head[1] & 0x80 else 0) :] if len(head) > 6 else b""
    if not ssh and (head[:1] != b"\x30" or body[:2] != b"\x02\x01" and body[:1] != b"\x30") or not 32 <= size <= KEY_BYTES:
        return None
    parts = wrapped_lines(text, start, -(-size // 3) * 4)
    if ssh:
        run = "".join(line for line, _ in parts)
        size = openssh_length(run, 0, len(run.rstrip("=")), False)
        parts = wrapped_lines(text, start, -(-size * 4 // 3))  # the container says how long it is; lines beyond are not part of it
    run = "".join(line for line, _ in parts)
    whole = len(parts) > 1 and size and len(run.rstrip("=")) == -(-size * 4 // 3)
    return parts[-1][1] if whole and is_private_key(decoded(run)) else None


def der_length(data: bytes) -> int:
    """Bytes of the DER item whose first bytes are ``data``, by its header."""
    if len(data) < 2 or not data[1] & 0x80:
        return 2 + data[1] if len(data) > 1 else 0
    n = data[1] & 0x7F
    return 2 + n + int.from_bytes(data[2 : 2 + n], "big") if 1 <= n <= 4 and len(data) >= 2 + n else 0


def key_within(run: str) -> tuple[int, int] | None:
    """Where a key stands in a run: at its start or after a separator in it (/, -, _), with or without 0x, up to the run's end.

    A start whose DER header does not tell the length of what follows is not decoded further.
    """
    plain = len(run.rstrip("="))
    last_safe = max(run.rfind("-"), run.rfind("_"))
    for m in KEY_START.finditer(run, 0, plain):
        at = m.end()
        n = plain - at
        if run.startswith(("30", "6f", "6F"), at):
            if n % 2 or not (run.startswith("6", at) or HEX_HEADER.match(run, at) and der_length(bytes.fromhex(run[at : at + 12])) * 2 == n):
                continue
            if HEX_ANY.fullmatch(run, at, plain) and is_private_key(bytes.fromhex(run[at:plain])):
                return at, plain
        else:
            url_safe = last_safe >= at
            if run[at] == "M":
                if -(-der_length(decoded(run[at : at + 8], url_safe) or b"") * 4 // 3) != n or not is_private_key(decoded(run[at:], url_safe)):
                    continue
            elif not (size := openssh_length(run, at, plain, url_safe)) or not is_private_key(decoded(run[at : at + -(-size * 4 // 3)], url_safe)):
                continue
            return at, len(run)
    return None


def is_json_object(part: str) -> dict | None:
    data = decoded(part, url_safe=True)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def confirmed_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    if "PRIVATE KEY-----" in text:
        edges = list(PEM_EDGE.finditer(text))
        for first, last in zip(edges, edges[1:], strict=False):
            if (first[1], last[1]) == ("BEGIN", "END") and first[2] == last[2] and is_pem_body(text[first.end() : last.start()]):
                spans.append(("pem", first.start(), last.end()))
    blocks, used = iter([(a, b) for _, a, b in spans] + [(len(text) + 1,) * 2]), 0
    block = next(blocks)
    for m in ENCODED.finditer(text):
        while block[1] <= m.start():
            block = next(blocks)
        start = m.start() + (text[max(0, m.start() - 1)] == "\\" and m[0][0] in "nrt")  # the letter of an escape is no part of a run
        if start < used or block[0] <= start:
            continue
        run = text[start : m.end()]
        found = key_within(run)
        if found:
            spans.append(("key", start + found[0], start + found[1]))
        elif run.startswith(("M", "b3BlbnNzaC1rZXktdjEA")) and BREAK.match(text, m.end()) and (end := wrapped_key(text, start)):
            spans.append(("key", start, end))
            used = end
    if "eyJ" in text:
        for m in TOKEN.finditer(text):
            header = is_json_object(m[1])
            if header and isinstance(header.get("alg"), str) and is_json_object(m[2]) is not None:
                spans.append(("jwt", m.start(), m.end()))
    return spans


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    low = text.lower()
    if any(cue in low for cue in ASSIGN_CUES):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return spans


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def scanner() -> Callable[[str], tuple]:
    def scan(text: str) -> tuple:
        base = base_spans(text)
        count = lambda kind: sum(s[0] == kind for s in base)
        digest = hashlib.sha256(joined(base).encode()).hexdigest()
        return count("assign"), count("access"), count("hex"), digest, joined(base + confirmed_spans(text))

    return scan


def find_secrets(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, counts of the three base kinds, the digest of the base spans and all spans (``kind:start:end``)."""
    return with_function(df, text, keep, scanner, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
