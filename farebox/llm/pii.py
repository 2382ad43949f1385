"""Personal data: patterns propose spans, checksums confirm them, and context words near a span move its score."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.spans import SPANS, Cover, blank_out
from farebox.llm.tasks import spare_names, with_python_columns

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "local_phone")
# Spans beyond the base need this score: half a point for the pattern, more for a checksum or a context word.
LEAST_SCORE = 0.7
CONTEXT_CHARS = 40

_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can begin only where a run of digits does, which keeps long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_REST = re.compile(r"(?: ?[A-Z0-9])+")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")

# Length of an account number by its country, as the standard's registry has it.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18,
    "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31,
    "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29,
    "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}

# Words whose nearness speaks for a kind.
CONTEXT = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|address|host|server|login)\b"),
    "card": re.compile(r"(?i)\b(?:card|credit|visa|mastercard|payment)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|call|tel|mobile|fax|cell)\b"),
    "iban": re.compile(r"(?i)\b(?:iban|account|bank|transfer|konto)\b"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social security)\b"),
    "local_phone": re.compile(r"(?i)\b(?:phone|call|tel|mobile|fax|cell)\b"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod_97(iban: str) -> bool:
    """Country and check digits moved to the end, letters as 10 to 35; the number leaves 1 when divided by 97."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def ibans(text: str) -> list[tuple[int, int]]:
    """Account numbers whose check digits hold: the length comes from the country, so letters and digits that follow after a
    space don't matter; groups may be apart by single spaces."""
    found, free = [], 0
    for m in _IBAN_START.finditer(text):
        length = IBAN_LENGTHS.get(m.group()[:2])
        if length is None or m.start() < free:
            continue
        # the rest with its spaces is never longer than twice the number
        rest = _IBAN_REST.match(text, m.end(), m.start() + 2 * length + 1)
        signs, stop = 4, m.end()
        for stop in range(m.end(), rest.end() if rest else m.end()):
            signs += text[stop] != " "
            if signs == length:
                break
        stop += 1
        whole = signs == length and not text[stop:stop + 1].isalnum()
        if whole and mod_97(text[m.start():stop].replace(" ", "")):
            found.append((m.start(), stop))
            free = stop
    return found


def emails(text: str) -> list[tuple[int, int]]:
    """The spans of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each ``@`` leftwards in linear time."""
    found, free = [], 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        start = m.start()
        while start > free and text[start - 1] in _LOCAL_PART:
            start -= 1
        if start < m.start():
            free = m.end()
            found.append((start, free))
    return found


def _small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start, stop of the base kinds; a match that fails its check is passed over as a whole."""
    found = [("email", *s) for s in emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small_part, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15] if "+" in text else []
    return found


def find_spans(text: str | None) -> list[tuple[str, int, int, float, bool]]:
    """All spans as (kind, start, stop, score, base), by kind as listed and then by start."""
    if not text:
        return []

    def near(kind: str, start: int, stop: int) -> bool:
        return bool(CONTEXT[kind].search(text[max(0, start - CONTEXT_CHARS):start]) or CONTEXT[kind].search(text[stop:stop + CONTEXT_CHARS]))

    found = [(k, a, b, 0.8 + 0.2 * near(k, a, b), True) for k, a, b in base_spans(text)]
    taken = Cover([(a, b) for _, a, b, _, _ in found])
    # an account number's checksum is proof enough; the others need a context word
    found += [("iban", a, b, min(1.0, 0.9 + 0.3 * near("iban", a, b)), False) for a, b in ibans(text)]
    for kind, pattern, holds in (("ssn", _SSN, _is_ssn), ("local_phone", _LOCAL_PHONE, bool)):
        for m in pattern.finditer(text):
            score = 0.5 + 0.3 * near(kind, *m.span())
            if holds(m.group()) and score >= LEAST_SCORE and not taken.touches(*m.span()):
                found.append((kind, *m.span(), score, False))
    return found


def _is_ssn(s: str) -> bool:
    return s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000"


def find_personal_data(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``pii_spans``, an array of (kind, start, stop, score, base) per text.

    NULL and empty texts have an empty array. Whole texts are searched in time linear in their length. Rows stand
    alone, so repeated rows give the same spans. A column of the name is replaced.
    """
    return with_python_columns(df, [text], f"pii_spans {SPANS}", lambda: lambda texts: [list(map(find_spans, texts))])


def redact_personal_data(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` (same columns, all rows) with personal data in ``text`` replaced by ``[KIND]``.

    NULL stays NULL and a text without findings as it is; repeated rows change alike; columns may have any name.
    """
    new, = spare_names(df, 1)

    def blank(t):
        return t if not t else blank_out(t, [(a, b, k) for k, a, b, _, _ in find_spans(t)])

    worked = with_python_columns(df, [text], f"`{new}` string", lambda: lambda texts: [list(map(blank, texts))])
    return worked.select(*[F.col(new).alias(c) if c == text else worked[f"`{c}`"] for c in df.columns])
