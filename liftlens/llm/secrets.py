"""Secrets in texts: patterns, then structural confirmation of encoded candidates.

Base kinds: an assignment to a secret's name (assign), an access key id (access), a long
hexadecimal run (hex). The method adds:
- token: three base64url parts joined by dots, the first a JSON object whose "alg" is a text (a
  signed token; five parts if it has "enc"). The header decides: the other parts may be
  any bytes, and one of them may be empty;
- key: a base64 or hex run whose bytes parse as a key: DER whose nested lengths fit to the last
  byte and whose fields are those of a PKCS#1, DSA, PKCS#8, SEC 1 or public key, or an SSH key whose
  length-prefixed fields do. A base64 run may be broken over lines (line breaks may be escaped): between
  BEGIN and END marks, where header lines may come first, or without marks, where the outermost DER
  length, of at most two bytes, tells the line on which it ends. Under headers that name a cipher, a
  body of whole cipher blocks is a key.

Defined results: a null or empty text has no spans; of the base kinds, matches that fail stay
consumed, as leftmost non-overlapping matching demands, and a failed token is searched again from its
second part; very long texts are scanned whole, in time that grows with their length; rows are
scanned one by one, so equal rows give equal results and an empty table gives none; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.llm.common import by_batch, slices

KINDS = ("assign", "access", "hex", "token", "key")
BASE = KINDS[:3]
MASK = "[secret]"

_ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a run is maximal, so a short one has no longer part
_HEX = re.compile(r"[0-9a-f]{16,}")
_TOKEN = re.compile(
    r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]*)\.([A-Za-z0-9_-]*)")
_MORE_PARTS = re.compile(r"(?:\.[A-Za-z0-9_-]*){2}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}")
_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40})KEY-----")
_BREAK = r"(?:\r?\n|(?:\\r)?\\n)[\x20\t]*"  # as itself or escaped
_BREAKS = re.compile(r"\\[rnt]|\s")
_LINES = re.compile(
    rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{32,}}(?:{_BREAK}[A-Za-z0-9+/_-]+)+={{0,2}}")
_LINE = re.compile(r"(?:(?<=\\n)|(?<![A-Za-z0-9+/_\\-]))[A-Za-z0-9+/_-]+")
_CIPHER = re.compile(r"DEK-Info:[^,\n]*,\s*((?:[0-9A-Fa-f]{16}){1,2})\s*$", re.MULTILINE)
_HEXRUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}(?![0-9A-Fa-f])")


def decoded(text: str) -> bytes | None:
    """Base64 of either alphabet, padding optional."""
    text = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def json_object(part: str) -> dict | None:
    data = decoded(part)
    if not data or not data.lstrip().startswith(b"{"):
        return None
    try:
        value = json.loads(data)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def der(data: bytes, depth: int = 0) -> list | None:
    """The (tag, content) list of consecutive DER values that fill `data` exactly; the content of
    constructed values is parsed in turn. None if a length does not fit."""
    out, at, n = [], 0, len(data)
    while at < n:
        if at + 2 > n:
            return None
        tag, length = data[at], data[at + 1]
        at += 2
        if length & 0x80:
            more = length & 0x7F
            if not 1 <= more <= 4 or at + more > n or data[at] == 0:
                return None
            length = int.from_bytes(data[at:at + more], "big")
            if length < 0x80:
                return None
            at += more
        if at + length > n:
            return None
        body = data[at:at + length]
        at += length
        if tag & 0x20:
            body = der(body, depth + 1) if depth < 16 else None
            if body is None:
                return None
        out.append((tag, body))
    return out


def is_der_key(data: bytes) -> bool:
    if len(data) < 24 or data[0] != 0x30:
        return False
    top = der(data)
    if not top or len(top) != 1:
        return False
    fields = top[0][1]
    tags = [t for t, _ in fields]
    if set(tags) == {2} and (len(tags) in (2, 6) or len(tags) >= 9):  # PKCS#1 public, DSA, private
        return len(fields[1 if len(tags) > 2 else 0][1]) >= 32
    if tags[:2] == [2, 4] and set(tags[2:]) <= {0xA0, 0xA1}:  # SEC 1
        return fields[0][1] == b"\x01" and len(fields[1][1]) >= 16
    has_oid = lambda x: bool(x) and x[0][0] == 6
    if tags[:3] == [2, 0x30, 4]:  # PKCS#8
        return has_oid(fields[1][1]) and len(fields[2][1]) >= 16
    if tags == [0x30, 4]:  # encrypted PKCS#8
        return has_oid(fields[0][1]) and len(fields[1][1]) >= 16
    return tags == [0x30, 3] and has_oid(fields[0][1]) and len(fields[1][1]) >= 16


def fields_fit(data: bytes, least: int) -> bool:
    """`data` is at least `least` values, each after its length in four bytes, and nothing else."""
    at = n = 0
    while at < len(data):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
        n += 1
    return at == len(data) and n >= least


def is_ssh_key(data: bytes) -> bool:
    magic = b"openssh-key-v1\0"
    if data.startswith(magic):
        at = len(magic)
        for _ in range(3):  # cipher, derivation, its options
            at += 4 + int.from_bytes(data[at:at + 4], "big")
            if at + 4 > len(data):
                return False
        keys = int.from_bytes(data[at:at + 4], "big")
        return 1 <= keys <= 64 and fields_fit(data[at + 4:], keys + 1)
    name = data[4:4 + int.from_bytes(data[:4], "big")] if data[:3] == b"\0\0\0" else b""
    return name.startswith((b"ssh-", b"ecdsa-", b"sk-")) and fields_fit(data, 2)


def is_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_ssh_key(data))


def armored(text: str):
    """(start, end) of the keys between marks. A body holds no five dashes, so every mark is
    looked at once or twice."""
    for m in _BEGIN.finditer(text):
        stop = text.find("-----", m.end())
        end = f"-----END {m[1]}KEY-----"
        if stop < 0 or not text.startswith(end, stop):
            continue
        lines = [x.strip() for x in re.split(r"\r?\n|(?:\\r)?\\n", text[m.end():stop])]
        n = max((i for i, x in enumerate(lines) if ":" in x), default=-1) + 1
        # the last header line may go on up to an empty line
        later = next((i for i in range(n, len(lines)) if n and not lines[i]), n)
        cipher = _CIPHER.search("\n".join(lines[:n]))
        for begin in sorted({n, later}):
            data = decoded(_BREAKS.sub("", "".join(lines[begin:])))
            if is_key(data) or cipher and data and len(data) % (len(cipher[1]) // 2) == 0:
                yield m.start(), stop + len(end)
                break


def der_length(head: str) -> int | None:
    """The bytes of a DER sequence, its own head included, from its first eight base64 characters."""
    data = decoded(head)
    if not data or data[0] != 0x30:
        return None
    if data[1] < 0x80:
        return 2 + data[1]
    more = data[1] & 0x7F
    return 2 + more + int.from_bytes(data[2:2 + more], "big") if 1 <= more <= 2 else None


def wrapped(text: str):
    """(start, end) of the DER keys broken over lines without marks: whole lines whose base64 has as
    many characters as the outermost length asks for."""
    for block in _LINES.finditer(text):
        lines = [m.span() for m in _LINE.finditer(text, block.start(), block.end())]
        ends = list(accumulate(b - a for a, b in lines))
        whole = None
        for i, (a, b) in enumerate(lines):
            if text[a] != "M" or b - a < 32:  # the first six bits of a sequence
                continue
            length = der_length(text[a:a + 8])
            if length is None:
                continue
            before = ends[i] - (b - a)
            want = before + (length * 8 + 5) // 6
            last = bisect_left(ends, want)
            if last == len(ends) or ends[last] != want:
                continue
            if whole is None:
                whole = "".join(text[x:y] for x, y in lines)
            if is_key(decoded(whole[before:want])):
                yield a, block.end() if last == len(ends) - 1 else lines[last][1]


def tokens(text: str):
    """(start, end) of signed tokens."""
    at = 0
    while m := _TOKEN.search(text, at):
        header = json_object(m[1])
        if header and isinstance(header.get("alg"), str) and (m[2] or m[3]):
            more = _MORE_PARTS.match(text, m.end()) if "enc" in header else None
            at = more.end() if more else m.end()
            yield m.start(), at
        else:
            at = m.end(1)


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; code points, end exclusive."""
    if not text:
        return []
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if "." in text:
        found += [("token", *s) for s in tokens(text)]
    keys = list(armored(text)) if "-----BEGIN " in text else []
    marked = [*keys]
    starts = [a for a, _ in marked]

    def outside(at: int) -> bool:
        i = bisect_right(starts, at) - 1
        return i < 0 or at >= marked[i][1]

    keys += [m.span() for m in _RUN.finditer(text) if outside(m.start()) and is_key(decoded(m[0]))]
    keys += [s for s in wrapped(text) if outside(s[0])]
    keys += [m.span() for m in _HEXRUN.finditer(text)
             if len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0]))]
    found += [("key", *s) for s in sorted(set(keys))]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def masked(text: str | None) -> str | None:
    """The text with every span (overlapping ones together) replaced by the mask."""
    found = spans(text)
    if not found:
        return text
    out, at = [], 0
    for _, start, end in found:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of each document, as an array of kind, start, end."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(t)]
                 for t in batch.column(1).to_pylist()]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, kind)], names=["doc_id", "found"])

    return by_batch(docs.select("doc_id", "text"), run,
                    "doc_id long, found array<struct<kind:string,start:long,end:long>>")


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [spans(t) for t in batch.column(1).to_pylist()]
        base = [[s for s in x if s[0] in BASE] for x in found]
        counts = [pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in BASE]
        return pa.RecordBatch.from_arrays([
            batch.column(0), *counts,
            pa.array([hashlib.sha256(joined(x).encode()).hexdigest() for x in base]),
            pa.array([joined(x) for x in found]),
        ], names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    return by_batch(docs.select("doc_id", "text"), run,
                    "doc_id long, n_assign long, n_access long, n_hex long, "
                    "base_sha256 string, spans string")


def mask(docs: DataFrame) -> DataFrame:
    """The documents with secrets masked; n_chars follows the new text. Other columns stay."""
    schema = docs.schema
    names = docs.columns
    at = names.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(batch.columns)
        columns[at] = pa.array([masked(t) for t in batch.column(at).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    out = docs.mapInArrow(lambda batches: map(run, slices(batches, at)), schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in names else out
