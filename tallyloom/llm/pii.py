"""Personal data: patterns propose spans, checksums confirm them, context words score them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Kinds in the order that breaks ties of start; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = 4
#: What a confirmed span scores before its context, by kind.
PRIOR = {"email": 0.6, "ip": 0.5, "card": 0.8, "phone": 0.5, "iban": 0.9, "ssn": 0.4}
#: Words that speak for a kind when they stand nearby.
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "credit", "visa", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "ssn": ("ssn", "social security", "insurance number"),
}
#: Characters of an account number, by country.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IT": 27, "LT": 20,
    "LU": 20, "LV": 21, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19,
    "SK": 24, "TR": 26,
}
CONTEXT_CHARS = 40
CONTEXT_SCORE = 0.2
KEEP_SCORE = 0.5

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match takes whole runs of digits, so none starts inside one.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    """The check of card numbers: from the right, every second digit counts doubled."""
    doubled = (2 * int(d) for d in digits[-2::-2])
    total = sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of international bank account numbers."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _account(match: str) -> str:
    """The match as far as its country's accounts go, where that ends a group of it."""
    length = IBAN_LENGTHS.get(match[:2], 0)
    own = ""
    for group in match.split(" ") if length else ():
        own = f"{own} {group}" if own else group
        if len(own.replace(" ", "")) == length:
            return own
    return match


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ to both sides, so that long words without one cost nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
            at = text.find("@", free)
        else:
            # No address can reach over this sign, and none starts before it.
            free = at + 1
            at = text.find("@", free)


def _numbers(text: str, kind: str) -> Iterator[tuple[int, int]]:
    if kind == "ip":
        for m in _IP.finditer(text):
            parts = [part.lstrip("0") for part in m[0].split(".")]
            if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
                yield m.span()
    elif kind == "card":
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    yield m.span()
    elif kind == "phone":
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                yield m.span()
    elif kind == "iban":
        for m in _IBAN.finditer(text):
            own = _account(m[0])
            compact = own.replace(" ", "")
            if 15 <= len(compact) <= 34 and mod97(compact):
                yield m.start(), m.start() + len(own)
    else:
        for m in _SSN.finditer(text):
            area, group, serial = m[0].split("-")
            if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
                yield m.span()


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = f"{text[max(0, start - CONTEXT_CHARS):start]} {text[end:end + CONTEXT_CHARS]}".lower()
    found = any(word in near for word in CONTEXT[kind])
    return min(1.0, PRIOR[kind] + CONTEXT_SCORE * found)


def find(text: str | None) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, score) of all spans of a text, sorted; offsets count code points."""
    found = []
    for k, kind in enumerate(KINDS):
        for start, end in _emails(text or "") if kind == "email" else _numbers(text or "", kind):
            score = _score(text, kind, start, end)
            if k < BASE or score >= KEEP_SCORE:
                found.append((start, k, end, score))
    return sorted(found)


def joined(spans: list) -> str:
    return ",".join(f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in spans)


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string, scores string"
)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with its spans of personal data.

    Patterns propose; parts of an address, Luhn's check, mod 97 and number ranges
    confirm; a word of :data:`CONTEXT` within :data:`CONTEXT_CHARS` characters adds
    to the score. Base kinds (email, ip, card, phone) are reported whatever their
    score; bank accounts and insurance numbers from :data:`KEEP_SCORE` on. ``scores``
    lists the scores in the order of ``spans``.

    NULL and empty texts have no spans and the hash of the empty string. Repeated
    rows give repeated results, an empty table gives none, other columns are not
    read. Each text is searched whole, in time linear in its length.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(1):
                spans = find(text.as_py())
                base = [s for s in spans if s[1] < BASE]
                counts = [sum(s[1] == k for s in base) for k in range(BASE)]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                scores = ",".join(f"{s[3]:.2f}" for s in spans)
                out.append((*counts, digest, joined(spans), scores))
            columns = list(zip(*out, strict=True)) or [[]] * 7
            arrays = [batch.column(0).cast(pa.int64())]
            arrays += [pa.array(c, pa.int64()) for c in columns[:BASE]]
            arrays += [pa.array(c, pa.string()) for c in columns[BASE:]]
            names = [part.split()[0] for part in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(id_col, text_col).mapInArrow(rows, SCHEMA)
