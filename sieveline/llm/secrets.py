"""Secrets in texts: patterns, and structure that confirms an encoded candidate before it is reported."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.arrow import map_rows
from sieveline.llm.tables import documents

#: Kinds in the order in which spans of one start are listed; the first three are patterns alone.
KINDS = ("assign", "access", "hex", "signed_token", "key_block", "encoded_key", "hex_key")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_ASSIGN = re.compile("(" + "|".join([*map(_either_case, _KEYWORDS[:4]), _either_case("api") + "_?" + _either_case("key")]) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*){2,}")
_BOUND = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*)PRIVATE KEY-----")
#: How base64 of a DER sequence or of an OpenSSH key begins: the first byte, or the magic, decides it.
_ENCODED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M[A-Za-z0-9+/_-]{15}|b3BlbnNzaC1r[A-Za-z0-9+/_-]{4})")
_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
_WRAP = re.compile(r"(?:\r?\n|\\r\\n|\\n)[\x20\t]*(?=[A-Za-z0-9+/_-])")
_LONG_HEX = re.compile(r"(?<![0-9A-Za-z])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Za-z])")
_OPENSSH = b"openssh-key-v1\0"

INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def der_elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of the elements that make up all of ``data``; None if their lengths do not."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def is_der_key(data: bytes) -> bool:
    """Whether ``data`` is one DER sequence that nests as a private key does; public keys and certificates do not."""
    top = der_elements(data)
    if not top or len(top) != 1 or top[0][0] != SEQUENCE:
        return False
    inner = der_elements(top[0][1])
    if not inner:
        return False
    tags, first = [t for t, _ in inner], inner[0][1]
    if len(tags) >= 9 and set(tags[:9]) == {INTEGER}:
        return first in (b"\0", b"\1")  # RSA
    if tags == [INTEGER] * 6:
        return first == b"\0"  # DSA
    if tags[:2] == [INTEGER, OCTETS]:
        return first == b"\1" and len(inner[1][1]) >= 16  # elliptic curve
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:
        algorithm = der_elements(inner[1][1])  # any, by algorithm
        return first in (b"\0", b"\1") and bool(algorithm) and algorithm[0][0] == OID
    if tags == [SEQUENCE, OCTETS]:
        algorithm = der_elements(first)  # any, encrypted
        return bool(algorithm) and algorithm[0][0] == OID and len(inner[1][1]) >= 16
    return False


def ssh_size(data: bytes) -> int | None:
    """How many bytes of ``data`` an OpenSSH private key at its start takes; None if its fields do not add up."""
    if not data.startswith(_OPENSSH):
        return None
    at, count = len(_OPENSSH), 3  # cipher, derivation and its options; then keys
    while count:
        if at + 4 > len(data):
            return None
        at, count = at + 4 + int.from_bytes(data[at : at + 4], "big"), count - 1
    if at + 4 > len(data):
        return None
    count, at = int.from_bytes(data[at : at + 4], "big") + 1, at + 4  # public keys and the private part
    for _ in range(count):
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at if at <= len(data) else None


def is_ssh_key(data: bytes) -> bool:
    return ssh_size(data) == len(data)


def is_private_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_ssh_key(data))


def der_size(data: bytes) -> int | None:
    """How many bytes the DER sequence that ``data`` begins with takes in all; None if it begins with none."""
    if len(data) < 6 or data[0] != SEQUENCE:
        return None
    size, at = data[1], 2
    if size & 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4:
            return None
        size, at = int.from_bytes(data[2 : 2 + width], "big"), 2 + width
    return at + size


def decode64(text: str) -> bytes | None:
    """Bytes of plain or URL-safe base64, with or without padding; None if it is neither."""
    core = re.sub(r"\s+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    if len(core) % 4 == 1:
        return None
    try:
        return base64.b64decode(core + "=" * (-len(core) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(header: str, payload: str) -> bool:
    """Whether the parts decode to the JSON header (with an algorithm) and JSON payload of a signed token."""
    try:
        first, second = (json.loads((decode64(p) or b"").decode("utf-8")) for p in (header, payload))
    except (ValueError, RecursionError):
        return False
    return isinstance(first, dict) and isinstance(first.get("alg"), str) and isinstance(second, dict)


def token_spans(text: str) -> list[tuple[int, int]]:
    """Signed tokens: three parts in a row of a dotted run, wherever in it they start; leading hyphens and underscores are not part of one.

    A header is a JSON object, so its base64 starts as that of a brace or of white space does; others are not decoded.
    """
    out = []
    for m in _DOTTED.finditer(text):
        parts, at, k = m[0].split("."), m.start(), 0
        while k + 2 < len(parts):
            head = parts[k].lstrip("-_")
            if head[:1] in ("e", "I", "C", "D") and len(head) >= 8 and is_signed_token(head, parts[k + 1]):
                end = at + len(parts[k]) + len(parts[k + 1]) + len(parts[k + 2]) + 2
                out.append((at + len(parts[k]) - len(head), end))
                at, k = end + 1, k + 3
            else:
                at, k = at + len(parts[k]) + 1, k + 1
    return out


def block_spans(text: str) -> list[tuple[int, int]]:
    """Private keys between a BEGIN line and the END line next to it that has its label.

    Line breaks may be escapes, lines may be quoted or indented, header lines may precede the body.  A body is DER or
    OpenSSH, or, where the headers say that it is encrypted, whole cipher blocks.
    """
    marks = list(_BOUND.finditer(text))
    out = []
    for a, b in zip(marks, marks[1:]):  # noqa: B905
        if (a[1], b[1]) != ("BEGIN", "END") or a[2] != b[2]:
            continue
        lines = [x.strip(" \t\"',;>|") for x in re.split(r"\r?\n|\\r\\n|\\n", text[a.end() : b.start()])]
        headers = [x for x in lines if ":" in x]
        data = decode64("".join(x for x in lines if ":" not in x))
        hidden = any("ENCRYPTED" in h for h in headers) and any(re.match(r"DEK-Info: ?[A-Z0-9-]+, ?[0-9A-Fa-f]{16,}$", h) for h in headers)
        if is_private_key(data) or hidden and data and len(data) % 8 == 0:
            out.append((a.start(), b.end()))
    return out


def encoded_spans(text: str) -> list[tuple[int, int]]:
    """Private keys in base64, on one line or wrapped over lines: the nested lengths say where a key ends, and there the base64 has to end."""
    out, done = [], 0
    for m in _ENCODED.finditer(text):
        if m.start() < done:
            continue
        runs, at, have, need = [], m.start(), 0, None
        head = decode64(m[0][:16])
        size = der_size(head) if head else None
        if size is None and (head is None or not head.startswith(_OPENSSH[: len(head)])):
            continue
        need = None if size is None else -(-size * 4 // 3)
        while (run := _RUN.match(text, at)) and (need is None or have < need):
            runs.append(run)
            have += len(run[0])
            wrap = _WRAP.match(text, run.end())
            if not wrap:
                break
            at = wrap.end()
        if need is None:
            joined = "".join(r[0] for r in runs)
            size = ssh_size(decode64(joined[: len(joined) // 4 * 4]) or b"")
            if size is None:  # the last bytes may be in an open group
                size = ssh_size(decode64(joined) or b"")
            if size is None:
                continue
            need = -(-size * 4 // 3)
        text_of, end = "", None
        for r in runs:
            text_of += r[0]
            if len(text_of) >= need:
                end = r.end() if len(text_of) == need else None
                break
        if end is not None and is_private_key(decode64(text_of)):
            end += len(re.match(r"={0,2}", text[end : end + 2])[0])
            out.append((m.start(), end))
            done = end
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the three plain patterns, in code points."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans whose decoded structure shows a signed token or a private key; keys within a key block are not listed again."""
    out = [(a, b, 3) for a, b in token_spans(text)]
    blocks = block_spans(text) if "PRIVATE KEY-----" in text else []
    out += [(a, b, 4) for a, b in blocks]
    single = [(a, b, 5) for a, b in encoded_spans(text)]
    single += [(m.start(), m.end(), 6) for m in _LONG_HEX.finditer(text) if is_private_key(bytes.fromhex(m[0]))]
    starts = [a for a, _ in blocks]
    out += [(a, b, k) for a, b, k in single if not (i := bisect_right(starts, a)) or b > blocks[i - 1][1]]
    return sorted(out, key=lambda s: (s[0], s[2]))


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base array, confirmed array): spans (start, end, kind) of each text, in code points, end exclusive.

    Null and empty texts have none.  Rows are independent: repeated rows and null doc_ids are scanned like any, and
    columns of other names are not looked at.  Base spans of one kind do not overlap; spans of different kinds may,
    and those of one start are listed in the order of KINDS.  Whole texts are scanned, in time about linear in their
    length.  An empty table gives an empty table.
    """

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        name = lambda spans: [{"start": a, "end": b, "kind": KINDS[k]} for a, b, k in spans]
        for x in slices:
            found = [(base_spans(t), confirmed_spans(t)) for t in (t or "" for t in x["text"])]
            yield {
                "doc_id": x["doc_id"],
                "base": [name(b) for b, _ in found],
                "confirmed": [name(c) for _, c in found],
                "base_sha256": [hashlib.sha256(listed(b).encode()).hexdigest() for b, _ in found],
                "spans": [listed(b + c) for b, c in found],
            }

    span = "array<struct<start:long,end:long,kind:string>>"
    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), rows, f"doc_id long, base {span}, confirmed {span}, base_sha256 string, spans string")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), "base_sha256", "spans")
