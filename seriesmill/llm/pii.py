"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

Kinds email, ip, card and phone are the base kinds; whatever their patterns and
validators confirm is reported.  Kind iban is added: a pattern, the mod-97 checksum and
the country's length make a span, with a score that context raises; the same
score tells callers of ``find`` how sure a base span is.

Every search starts at a character that its pattern cannot do without and never
reads a run of characters twice, so the time is linear in the length of a text.

Edge cases: null and empty texts have no spans.  Repeated rows are searched each
for itself.  Offsets count code points.  Further columns are ignored by ``digest``
and kept by ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import map_texts


KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]
_ORDER = {k: i for i, k in enumerate(KINDS)}

# Fixed by the contract: the base patterns.  A number that starts inside a run of digits
# could never begin the leftmost match, which the lookbehinds say so that no run is read twice.
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# a start, and from there on the characters of the longest number
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_IBAN_REST = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")

# Lengths of account numbers by country of the registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18,
    "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23,
    "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28,
    "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
    "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}

CONTEXT = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
}
AGAINST = ("version", "order", "invoice", "example", "part", "isbn", "ticket", "serial")
_START = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.9}
NEAR = 48  # characters before a span that are read for context
STEP = 0.2
LEAST = 0.5  # added spans need this score
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(number: str) -> bool:
    """The account checksum: letters as two digits, the first four characters last."""
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # where the next match may begin
    at = text.find("@")
    while at >= 0:
        # the run of local characters before the sign, read backwards once
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(free, at + 1))


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _valid_iban(found: str) -> str | None:
    """The longest confirmed number at the start of a proposal."""
    bare = found.replace(" ", "")
    want = IBAN_LENGTHS.get(bare[:2], 0)
    if not want or len(bare) < want or not mod97(bare[:want]):
        return None
    taken, i = 0, 0
    while taken < want:
        taken += found[i] != " "
        i += 1
    return found[:i]


def proposals(text: str) -> Iterator[tuple[int, str, int]]:
    """Confirmed spans as (start, kind, end), kind by kind."""
    for start, end in _emails(text):
        yield start, "email", end
    for m in _IP.finditer(text):
        if all(_small(part) for part in m.group().split(".")):
            yield m.start(), "ip", m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _only_digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.start(), "card", m.end()
    for m in _PHONE.finditer(text):
        if 10 <= len(_only_digits(m.group())) <= 15:
            yield m.start(), "phone", m.end()
    free = 0
    for m in _IBAN.finditer(text):
        # starts inside a confirmed number are its own characters
        rest = _IBAN_REST.match(text, m.start()) if m.start() >= free and m.group()[:2] in IBAN_LENGTHS else None
        held = _valid_iban(rest.group()) if rest else None
        free = m.start() + len(held) if held else free
        if held and not _inside(text, free):
            yield m.start(), "iban", free


def _inside(text: str, at: int) -> bool:
    """Whether a word goes on at a place."""
    return at < len(text) and text[at].isascii() and text[at].isalnum()


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def score(text: str, start: int, kind: str) -> float:
    near = {w.lower() for w in _WORD.findall(text, max(0, start - NEAR), start)}
    up = any(w in near for w in CONTEXT[kind])
    down = any(w in near for w in AGAINST)
    return min(1.0, max(0.0, _START[kind] + STEP * up - STEP * down))


def find(text: str | None) -> list[tuple[int, str, int, float]]:
    """All spans of a text by start, then kind: (start, kind, end, score)."""
    if not text:
        return []
    made = [(s, k, e, score(text, s, k)) for s, k, e in proposals(text)]
    made = [x for x in made if x[1] in BASE or x[3] >= LEAST]
    return sorted(made, key=lambda x: (x[0], _ORDER[x[1]], x[2]))


def _written(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e, _ in spans)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, a count per base kind, base_sha256, spans, min_score (of all spans, null if none)."""

    def made(texts: list) -> dict:
        found = [find(t) for t in texts]
        base = [[x for x in spans if x[1] in BASE] for spans in found]
        counts = {f"n_{kind}": [sum(x[1] == kind for x in spans) for spans in base] for kind in BASE}
        least = [min((x[3] for x in spans), default=None) for spans in found]
        return counts | {
            "base_sha256": [sha256(_written(spans).encode()).hexdigest() for spans in base],
            "spans": [_written(spans) for spans in found],
            "min_score": pa.array(least, pa.float64()),
        }

    schema = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, min_score double"
    return map_texts(docs, ["doc_id"], "text", schema, made)


def masked(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets; spans that overlap become one."""
    if not text:
        return text
    out, at = [], 0
    for start, kind, end, _ in find(text):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns, spans in ``text`` masked."""
    mask = F.pandas_udf(lambda s: s.map(masked, na_action="ignore"), "string")
    return docs.withColumn("text", mask("text"))

