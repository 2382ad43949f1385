"""Secret scans with structural confirmation.

Base patterns report assignments, access keys and long hex runs. Beyond them, runs that look like base64 or hex are
decoded, and reported only if what comes out has the structure of a key: nested DER lengths that add up, the
length-prefixed fields of an OpenSSH key, or a signed token whose header names its algorithm.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.spans import SPANS, Cover, blank_out
from farebox.llm.tasks import spare_names, with_python_columns

BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("pem", "token", "der", "ssh")
_KIND_ORDER = {k: i for i, k in enumerate(BASE_KINDS + ADDED_KINDS)}

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_HEX_PAIRS = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}")
_SIGNED = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{8,}+)\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]*+)")
# a body holds no further marker, so each is searched once
_ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]++)-----((?:[^-]++|-(?!----))*+)-----END \1-----")
# line breaks of a body: real ones, and those that a string in a source or JSON file spells out
_BREAK = re.compile(r"\r\n?|\n|(?:\\+r)?\\+n")
# No pattern but the assignments and armoured blocks matches less than this without white space.
_SHORTEST_RUN = 16


def decode_base64(run: str) -> bytes | None:
    """Bytes of a base64 run in either alphabet, padded or not; None if it isn't one."""
    run = run.rstrip("=").translate({ord("-"): "+", ord("_"): "/"})
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except binascii.Error:
        return None


def _der_length(data: bytes, at: int) -> tuple[int, int]:
    """Start and stop of the content whose length stands at ``at``; raises on lengths that no encoder writes."""
    first = data[at]
    if first < 0x80:
        return at + 1, at + 1 + first
    size = first & 0x7F
    if not 1 <= size <= 4 or at + 1 + size > len(data):
        raise ValueError("length")
    length = int.from_bytes(data[at + 1:at + 1 + size], "big")
    if length < 0x80 or size > 1 and length >> 8 * (size - 1) == 0:
        raise ValueError("length")
    return at + 1 + size, at + 1 + size + length


def is_der_key(data: bytes) -> bool:
    """One SEQUENCE that fills ``data``, whose nested lengths all add up and that holds a number, bit or octet string of
    16 bytes or more."""
    if len(data) < 24 or data[0] != 0x30:
        return False
    long_value, waiting = False, [(0, len(data), True)]
    try:
        while waiting:
            at, end, outermost = waiting.pop()
            while at < end:
                tag = data[at]
                start, stop = _der_length(data, at + 1)
                if stop > end:
                    return False
                if tag & 0x20:
                    waiting.append((start, stop, False))
                elif tag in (2, 3, 4):
                    long_value |= stop - start >= 16
                elif tag not in (1, 5, 6, 12, 19, 23, 24) and tag < 0x80:
                    return False
                if outermost and stop != len(data):
                    return False
                at = stop
    except (IndexError, ValueError):
        return False
    return long_value


def is_ssh_key(data: bytes) -> bool:
    """The fields of an OpenSSH key: length-prefixed, the first naming the kind, and together filling ``data``."""
    magic = b"openssh-key-v1\0"
    if data.startswith(magic):
        at, fields = len(magic), 0
        while fields < 3 and at + 4 <= len(data):
            at += 4 + int.from_bytes(data[at:at + 4], "big")
            fields += 1
        return fields == 3 and at + 4 <= len(data)
    at, fields = 0, []
    while at + 4 <= len(data):
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            return False
        fields.append(data[at + 4:at + 4 + size])
        at += 4 + size
    return at == len(data) and len(fields) >= 2 and bool(re.fullmatch(rb"(ssh|ecdsa|sk-ssh|sk-ecdsa)-[a-z0-9@.-]{3,50}", fields[0]))


def is_token_header(part: str) -> bool:
    """A JSON object that names its algorithm."""
    try:
        header = json.loads(decode_base64(part) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def _armoured(text: str) -> list[tuple[int, int]]:
    """BEGIN/END blocks whose body decodes to a key (or whose header lines say that it is encrypted)."""
    found = []
    for m in _ARMOUR.finditer(text):
        body = m.group(2)
        data = decode_base64("".join(line.strip() for line in _BREAK.split(body) if ":" not in line)) or b""
        if is_der_key(data) or is_ssh_key(data) or "ENCRYPTED" in body and len(data) >= 32:
            found.append(m.span())
    return found


def key_kind(data: bytes) -> str | None:
    """What kind of key the bytes are: DER, OpenSSH, or an armoured block (as base64 of a whole key file has it)."""
    if is_der_key(data):
        return "der"
    if is_ssh_key(data):
        return "ssh"
    if b"-----BEGIN " in data and _armoured(data.decode("latin-1")):
        return "pem"
    return None


def find_spans(text: str | None) -> list[tuple[str, int, int, float, bool]]:
    """All spans as (kind, start, stop, score, base), by start and then by kind as listed."""
    if not text:
        return []
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span(), 0.7, True) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    armour = Cover(_armoured(text) if "-----BEGIN " in text else [])
    found += [("pem", *s, 1.0, False) for s in armour.spans]
    if max(map(len, text.split()), default=0) >= _SHORTEST_RUN:
        found += [("access", *m.span(), 0.9, True) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
        found += [("hex", *m.span(), 0.6, True) for m in _HEX.finditer(text)]
        for m in _SIGNED.finditer(text):
            if is_token_header(m.group(1)):
                found.append(("token", *m.span(), 1.0, False))
        for pattern, decode in ((_HEX_PAIRS, bytes.fromhex), (_BASE64, decode_base64)):
            for m in pattern.finditer(text):
                kind = key_kind(decode(m.group()) or b"")
                if kind and not armour.touches(m.start(), m.start() + 1):
                    found.append((kind, *m.span(), 1.0, False))
    return sorted(found, key=lambda s: (s[1], _KIND_ORDER[s[0]]))


def find_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``secret_spans``, an array of (kind, start, stop, score, base) per text.

    NULL and empty texts have an empty array. Whole texts are searched in time linear in their length. Rows stand
    alone, so repeated rows give the same spans. A column of the name is replaced.
    """
    return with_python_columns(df, [text], f"secret_spans {SPANS}", lambda: lambda texts: [list(map(find_spans, texts))])


def redact_secrets(documents: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``documents`` (same columns, all rows) with secrets in the text replaced by ``[KIND]`` and ``n_chars``, if there is such
    a column, of changed texts counted anew.

    NULL stays NULL and texts without secrets stay as they are, repeated rows change alike, an empty table stays empty.
    Whole texts are searched, however long. Columns may have any name and type.
    """
    new, changed = spare_names(documents, 2)

    def make():
        def compute(texts):
            spans = [[(a, b, k) for k, a, b, _, _ in find_spans(t)] for t in texts]
            return [[blank_out(t, s) if s else t for t, s in zip(texts, spans)], [bool(s) for s in spans]]

        return compute

    worked = with_python_columns(documents, [text], f"`{new}` string, `{changed}` boolean", make)

    def column(name):
        if name == text:
            return F.col(new).alias(name)
        if name == n_chars:
            counted = F.char_length(F.col(new)).cast(documents.schema[name].dataType)
            return F.when(F.col(changed), counted).otherwise(worked[f"`{name}`"]).alias(name)
        return worked[f"`{name}`"]

    return worked.select(*[column(c) for c in documents.columns])
