"""Secret scans with structural confirmation.

Base matches come from three patterns.  Beyond them, long base64 and hexadecimal runs, armoured
blocks and dotted tokens are candidates only: they are decoded and reported when what they hold
has the structure of a key or a signed token.  A key is DER (nested lengths that fill their
parents exactly, and the fields of a private key) or the length-prefixed private key format of
SSH.  Base64 that is wrapped over lines is joined, and base64 of an armoured block is decoded twice.
A signed token has a JSON header that names its algorithm and a JSON object as payload.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import text_of

# Fixed patterns of the base matches, with the least length of what they must hold.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more is a whole run of [0-9a-f]+
KINDS = ("assign", "access", "hex", "armour", "der", "ssh", "jwt")

_ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----([A-Za-z0-9+/=\s\\]+)-----END \1-----")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_LONG_HEX = re.compile(r"[0-9A-Fa-f]{64,}")
# From the front of a run and without going back, so that a long run is read once.
_SIGNED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]+")
_SSH_MAGIC = b"openssh-key-v1\x00"
# Runs of base64, one a line, the first of them long; breaks may be escaped.
_BREAK = r"(?:\\[rn]|[\r\n])+[ \t]*"
_LINES = re.compile(rf"[A-Za-z0-9+/_-]{{40,}}(?:{_BREAK}[A-Za-z0-9+/_-]+)*={{0,2}}")
_LINE = re.compile(rf"(?:{_BREAK})?([A-Za-z0-9+/_=-]+)")
# What base64 of an armour's first line holds, at each of the three places in a group of bytes.
_ARMOURED = re.compile("|".join(base64.b64encode(b"x" * i + b"-----BEGIN ").decode()[(0, 2, 3)[i] : -4] for i in range(3)))


def decoded(text: str) -> bytes | None:
    """Bytes of a base64 text in either alphabet, padded or not; None where it is none."""
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


# --- structures ------------------------------------------------------------------------


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value at ``at``; None unless its length fits below ``end``."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or at + width > end:
            return None
        size, at = int.from_bytes(data[at : at + width], "big"), at + width
    return (tag, at, at + size) if at + size <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``at`` to ``end`` exactly."""
    found = []
    while at < end:
        element = _element(data, at, end)
        if element is None:
            return None
        found.append(element)
        at = element[2]
    return found


def _nested(data: bytes, parts: list[tuple[int, int, int]], depth: int = 0) -> bool:
    """Whether each constructed element is filled by its own elements, all the way down."""
    for tag, at, end in parts:
        if tag & 0x20:
            inner = _children(data, at, end) if depth < 16 else None
            if inner is None or not _nested(data, inner, depth + 1):
                return False
    return True


def is_der_key(data: bytes) -> bool:
    """A private key in DER: RSA, EC, DSA, or any wrapped with its algorithm, encrypted or not."""
    top = _element(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = _children(data, top[1], top[2])
    if not parts or not _nested(data, parts):
        return False
    tags = [tag for tag, _, _ in parts]
    value = [data[at:end] for _, at, end in parts]
    small = tags[0] == 0x02 and len(value[0]) == 1 and value[0][0] <= 1
    plain = small and len(tags) >= 6 and all(tag == 0x02 for tag in tags[:6])
    curve = small and value[0][0] == 1 and tags[1:2] == [0x04]
    wrapped = small and tags[1:3] == [0x30, 0x04] and _names_algorithm(data, parts[1])
    sealed = tags == [0x30, 0x04] and _names_algorithm(data, parts[0])
    return plain or curve or wrapped or sealed


def _names_algorithm(data: bytes, part: tuple[int, int, int]) -> bool:
    inner = _children(data, part[1], part[2])
    return bool(inner) and inner[0][0] == 0x06


def ssh_end(data: bytes) -> int | None:
    """Where a private key of SSH ends: magic, three strings, a count, then that many keys and one secret part."""
    if not data.startswith(_SSH_MAGIC):
        return None
    at = len(_SSH_MAGIC)

    def string() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    if any(string() is None for _ in range(3)) or at + 4 > len(data):
        return None
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    return at if 1 <= keys <= 16 and all(string() is not None for _ in range(keys + 1)) else None


def is_ssh_key(data: bytes) -> bool:
    return ssh_end(data) is not None


def is_signed_token(text: str) -> bool:
    """Header, payload and signature; the header is JSON that names its algorithm."""
    parts = text.split(".")
    if len(parts) != 3:
        return False
    header, payload = _json(parts[0]), _json(parts[1])
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(payload, dict) and decoded(parts[2]) is not None


def _json(part: str):
    data = decoded(part)
    if not data or data.lstrip()[:1] != b"{":
        return None
    try:
        return json.loads(data)
    except (ValueError, RecursionError):
        return None


# --- scan ------------------------------------------------------------------------------


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def armoured_spans(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _ARMOUR.finditer(text):
        data = decoded(re.sub(r"\\[nr]|\s", "", m[2]))
        if data and (is_der_key(data) or is_ssh_key(data)):
            found.append(m.span())
    return found


def _leading(chars: str) -> bytes:
    """Bytes of the whole groups of four characters."""
    return decoded(chars[: len(chars) // 4 * 4]) or b""


def _held(runs: list[str], at: int) -> tuple[str, int] | None:
    """Kind and end in bytes of the key that the lines of base64 from ``at`` begin with or hold armoured."""
    if runs[at][0] == "M" and len(runs) > at + 1:
        # Its first bytes say how long it is; no more lines are joined than that.
        start = _leading("".join(runs[at : at + 4])[:16])
        top = _element(start, 0, 1 << 32) if len(start) == 12 else None
        chars, line = "", at
        while top and len(chars) * 3 < top[2] * 4 and line < len(runs):
            taken = runs[line : line + 64]
            chars, line = chars + "".join(taken), line + len(taken)
        data = decoded(chars[: -(-top[2] * 4 // 3)]) if top else None
        if data and is_der_key(data):
            return "der", top[2]
    if runs[at].startswith("b3BlbnNzaC1rZXktdjE") and len(runs) > at + 1:
        chars = "".join(runs[at:])
        if end := ssh_end(decoded(chars) or _leading(chars)):
            return "ssh", end
    if _ARMOURED.search("".join(runs[at : at + 2])):
        chars = "".join(runs[at:])
        spans = armoured_spans((decoded(chars) or _leading(chars)).decode("latin-1"))
        return ("armour", max(end for _, end in spans)) if spans else None
    return None


def wrapped_spans(text: str) -> list[tuple[str, int, int]]:
    """Keys in base64 over several lines, and armoured blocks in base64 of any number of lines."""
    found = []
    for m in _LINES.finditer(text):
        lines = [line.span(1) for line in _LINE.finditer(text, m.start(), m.end())]
        runs = [text[start:end].rstrip("=") for start, end in lines]
        at = 0
        while at < len(lines):
            held = _held(runs, at)
            last = at
            if held:
                need = -(-held[1] * 4 // 3) - len(runs[at])
                while need > 0 and last + 1 < len(lines):
                    last += 1
                    need -= len(runs[last])
                # A bare key ends with its last line, and one on a single line is found as such.
                if held[0] == "armour" or (last > at and need == 0):
                    found.append((held[0], lines[at][0], lines[last][1]))
                else:
                    last = at
            at = last + 1
    return found


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    armoured = armoured_spans(text)
    found = [("armour", *span) for span in armoured]
    # The lines within an armour are reported with it.
    found += [w for w in wrapped_spans(text) if not any(start <= w[1] and w[2] <= end for start, end in armoured)]
    for m in _BASE64.finditer(text):
        if m[0][0] in "Mb" and (data := decoded(m[0])):
            if is_der_key(data):
                found.append(("der", *m.span()))
            elif is_ssh_key(data):
                found.append(("ssh", *m.span()))
    for m in _LONG_HEX.finditer(text):
        if len(m[0]) % 2 == 0 and m[0][:2] in ("30", "6f", "6F"):
            data = bytes.fromhex(m[0])
            if is_der_key(data):
                found.append(("der", *m.span()))
            elif is_ssh_key(data):
                found.append(("ssh", *m.span()))
    return found + [("jwt", *m.span()) for m in _SIGNED.finditer(text) if is_signed_token(m[0])]


def _joined(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


_REPORT = "n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string"


def _report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [field.split()[0] for field in _REPORT.split(", ")]
    for texts in batches:
        rows = []
        for text in texts:
            base, more = base_spans(text), confirmed_spans(text)
            counts = [sum(kind == k for kind, _, _ in base) for k in KINDS[:3]]
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            rows.append((*counts, len(more), digest, _joined(base + more)))
        yield pd.DataFrame(rows, columns=names)


def report(text: Column) -> Column:
    """A struct for one text: counts of the base kinds and of confirmed structures, and the spans.

    ``spans`` lists kind:start:end by start, then kind, comma-joined, in code points with the end
    exclusive; ``base_sha256`` is the digest of that list for the base kinds alone.
    """
    return F.pandas_udf(_report, _REPORT)(text)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and its report.

    A null text is an empty one, its lists are empty.  A null doc_id stays null, repeated rows
    are reported each, an empty table gives no rows.  Other columns are not read.
    """
    return docs.select("doc_id", report(text_of()).alias("r")).select("doc_id", "r.*")


def _redacted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def one(text: str) -> str:
        out, at = [], 0
        for kind, start, end in sorted(base_spans(text) + confirmed_spans(text), key=lambda s: s[1:]):
            if start >= at:
                out += [text[at:start], f"<{kind}>"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    for texts in batches:
        yield texts.map(one)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by its kind in angle brackets, ``n_chars`` recounted where it exists.

    Overlapping spans are replaced together under the first one's kind.  Texts without a span,
    null ones too, stay as they are.
    """
    clean = F.when(F.col("text").isNotNull(), F.pandas_udf(_redacted, "string")(text_of()))
    out = docs.withColumn("text", clean)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
