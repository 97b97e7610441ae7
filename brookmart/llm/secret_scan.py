"""Find secrets by pattern, and by decoding what looks encoded.

The base kinds are patterns. The method adds kinds that are reported only when their structure is
confirmed: PEM blocks and bare base64 or hexadecimal runs whose bytes parse as a key (nested ASN.1 lengths
that end where the data ends, or the length-prefixed fields of an SSH key), and signed tokens whose header is
JSON that names an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import importable, whole

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of the class are maximal, so asking for 32 finds the runs of 32 and more and skips the rest.
HEX = re.compile(r"[0-9a-f]{32,}")
PEM_MARK = re.compile(r"(?=-----(BEGIN|END) ([A-Z0-9 ]*)-----)")
NOT_IN_PEM = re.compile(r"[^A-Za-z0-9+/=\s:,-]")
ENCODED = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
LONG_HEX = re.compile(r"(?:[0-9a-f]{2}){24,}|(?:[0-9A-F]{2}){24,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
KINDS = ("assign", "access", "hex", "pem", "key64", "keyhex", "jwt")

INTEGER, BITS, OCTETS, NULL, OID, SEQUENCE, SET = 0x02, 0x03, 0x04, 0x05, 0x06, 0x30, 0x31


def der_elements(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """Tag, start and end of the value of each element in data[start:end]; None unless they fill it exactly."""
    found = []
    while start < end:
        if start + 2 > end:
            return None
        tag, n = data[start], data[start + 1]
        start += 2
        if n & 0x80:
            width = n & 0x7F
            if not 1 <= width <= 4 or start + width > end:
                return None
            n = int.from_bytes(data[start:start + width], "big")
            start += width
        if start + n > end:
            return None
        found.append((tag, start, start + n))
        start += n
    return found


def is_der_key(data: bytes) -> bool:
    """A sequence that fills the data, with the fields of a private or public key."""
    top = der_elements(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != SEQUENCE:
        return False
    fields = der_elements(data, *top[0][1:])
    if not fields or len(fields) < 2:
        return False
    tags = [f[0] for f in fields]
    algorithm = next((der_elements(data, *f[1:]) for f in fields[:2] if f[0] == SEQUENCE), None)
    named = bool(algorithm) and algorithm[0][0] == OID
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] or tags[:2] == [SEQUENCE, BITS] or tags[:2] == [SEQUENCE, OCTETS]:
        return named  # key with its algorithm: private, public, encrypted
    if tags[:2] == [INTEGER, OCTETS]:
        return True  # elliptic curve
    return len(tags) >= 6 and set(tags) == {INTEGER}  # numbers of an RSA or DSA key


def is_ssh_key(data: bytes) -> bool:
    """Length-prefixed fields behind the magic of a private key, or the name of a public key's algorithm."""
    magic = b"openssh-key-v1\x00"
    at, fields = (len(magic) if data.startswith(magic) else 0), []
    while at + 4 <= len(data) and len(fields) < 3:
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data):
            return False
        fields.append(data[at + 4:at + 4 + n])
        at += 4 + n
    if data.startswith(magic):
        return len(fields) == 3
    return len(fields) >= 2 and bool(re.fullmatch(rb"(ssh-|ecdsa-|sk-)[a-z0-9@.-]+", fields[0]))


def is_key(data: bytes) -> bool:
    return is_der_key(data) or is_ssh_key(data)


def from_base64(text: str) -> bytes | None:
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(header: str, payload: str) -> bool:
    raw = from_base64(header)
    if not raw or raw[:1] != b"{" or from_base64(payload) is None:
        return False
    try:
        fields = json.loads(raw)
    except (ValueError, RecursionError):
        return False
    return isinstance(fields, dict) and isinstance(fields.get("alg"), str)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def pem_blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and body of each block from a BEGIN mark to the next END mark of its label, leftmost first and without overlaps.

    Between the marks stand only characters that keys and their header lines have. Marks are found first and then paired, so the
    time does not grow with the number of marks left open.
    """
    begins: list[tuple[int, str]] = []
    ends: dict[str, list[int]] = {}
    for m in PEM_MARK.finditer(text):
        if m[1] == "BEGIN":
            begins.append((m.start(), m[2]))
        else:
            ends.setdefault(m[2], []).append(m.start())
    done, barrier = 0, -1
    for start, label in begins:
        body = start + len("-----BEGIN -----") + len(label)
        marks = ends.get(label, [])
        if start < done or (k := bisect_left(marks, body)) == len(marks):
            continue
        if barrier < body:
            other = NOT_IN_PEM.search(text, body)
            barrier = other.start() if other else len(text)
        if marks[k] <= barrier:
            done = marks[k] + len("-----END -----") + len(label)
            yield start, done, text[body:marks[k]]


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of keys and signed tokens whose structure holds. A run inside a confirmed PEM block is not told again."""
    found = []
    if "-----BEGIN " in text:
        for start, end, lines in pem_blocks(text):
            data = from_base64("".join(line for line in lines.split() if ":" not in line))
            # Old encrypted keys say so in header lines; their bytes cannot be parsed.
            if data and (is_key(data) or ("ENCRYPTED" in lines and len(data) % 8 == 0)):
                found.append((start, 3, end))
    starts, ends = [s for s, _, _ in found], [e for _, _, e in found]

    def outside(m: re.Match) -> bool:
        k = bisect_right(starts, m.start())
        return not k or ends[k - 1] < m.end()

    for m in ENCODED.finditer(text):
        # A key starts with its SEQUENCE tag (0x30), a length prefix (0x00) or the SSH magic.
        if m[0][0] in "MAb" and outside(m) and (data := from_base64(m[0])) and is_key(data):
            found.append((m.start(), 4, m.end()))
    for m in LONG_HEX.finditer(text):
        if m[0][:2] in ("30", "00", "6f", "6F") and outside(m) and is_key(bytes.fromhex(m[0])):
            found.append((m.start(), 5, m.end()))
    if "." in text and "ey" in text:
        found += [(m.start(), 6, m.end()) for m in TOKEN.finditer(text) if m[1][:2] == "ey" and is_signed_token(m[1], m[2])]
    return found


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every text: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` lists kind:start:end in code points, end exclusive, by start and then by kind; ``base_sha256`` is
    of the same list with the base kinds alone. One row per row of ``docs``; null and empty texts have none (empty list). Null or
    repeated identifiers are carried through. Other columns are not read.
    """
    importable(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column(1):
                text = text.as_py()
                base = base_spans(text)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append((*counts, hashlib.sha256(told(base).encode()).hexdigest(), told(base + confirmed_spans(text))))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.record_batch([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                                  names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
