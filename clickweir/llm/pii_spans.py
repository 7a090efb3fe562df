r"""PII: patterns propose spans, checksums confirm them, context words adjust the score.

Base kinds (email, ip, card, phone) are decided by pattern and validator alone and never
dropped. The method adds kinds whose pattern alone says little:

* ``iban``: country letters, two check digits and up to 30 further characters; confirmed
  by mod-97. Words and numbers may follow it behind a blank, so every end of a group is tried:
  first the length of the country, then the others from the longest on;
* ``id_number``: 9 to 12 digits in groups, confirmed only by context words before it;
* ``secret``: a long mixed token that follows a word such as ``password`` or ``token``, or
  an access key of a fixed form.

Each proposal starts with the score of its kind; a passed checksum and nearby context words
raise it, words such as ``example`` lower it, and spans of ``KEEP`` or more stay. Every
pattern is written so that a text is scanned in linear time, however long its runs are.

Defined results: a null text is empty; a document without spans has zero counts and empty
lists; a null doc_id stays null; repeated rows are reported once per row; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "id_number", "secret")
KEEP = 0.5

# What a kind is worth before its context is read, and the words around it.
START = {"iban": 0.2, "id_number": 0.15, "secret": 0.3}
CHECKSUM = 0.6
CONTEXT = 0.4
DOUBT = 0.4
NEAR = 40
WORDS = {
    "iban": re.compile(r"(?i)\b(?:iban|bank|account|konto|cuenta|compte)\b"),
    "id_number": re.compile(r"(?i)\b(?:ssn|social security|passport|tax id|driver'?s licen[cs]e|steuernummer|dni|nif)\b"),
    "secret": re.compile(r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b"),
}
DOUBTS = re.compile(r"(?i)\b(?:example|sample|dummy|placeholder)\b")

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_IBAN_LEAST = 15
# Lengths in the registry of ISO 13616.
_IBAN_LENGTHS = {
    country: size for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items() for country in countries.split()
}
_ID = re.compile(r"(?<![0-9A-Za-z.-])[0-9]{2,4}(?:[ -]?[0-9]{2,4}){2,3}(?![0-9A-Za-z])")
_SECRET = re.compile(
    r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
    r"|(?<=[=: \"'])[A-Za-z0-9_/+-]{12,}+)"
)
_KEY = re.compile(r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key)[\"' ]{0,2}[=:][\"' ]{0,2}\Z")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ is met once: its local part reaches back to the last match at most."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        end = at + 1
        if start < at and (found := _DOMAIN.match(text, at + 1)):
            end = done = found.end()
            yield start, end
        else:
            done = at + 1
        at = text.find("@", end)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Spans confirmed by mod-97; behind a failed proposal the search goes on after its check digits."""
    m = _IBAN.search(text)
    while m:
        start = at = m.start()
        ends, size = [], 0  # (characters without blanks, end) of every group, longest first
        for group in m[0].split(" "):
            at += len(group) + 1
            size += len(group)
            if size >= _IBAN_LEAST:
                ends.insert(0, (size, at - 1))
        own = _IBAN_LENGTHS.get(m[0][:2])
        ends.sort(key=lambda x: x[0] != own)
        end = next((end for _, end in ends if mod97(text[start:end].replace(" ", ""))), None)
        if end is not None:
            yield start, end
        m = _IBAN.search(text, start + 4 if end is None else end)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_byte(digits: str) -> bool:
    value = digits.lstrip("0")
    return len(value) <= 3 and int(value or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    if _HAS_DIGIT.search(text) is None:
        return found
    found += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(map(_is_byte, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return found


_HAS_DIGIT = re.compile("[0-9]")


def _score(kind: str, text: str, start: int, end: int, checked: bool) -> float:
    around = text[max(0, start - NEAR):start] + " " + text[end:end + NEAR // 2]
    score = START[kind] + CHECKSUM * checked
    score += CONTEXT * (WORDS[kind].search(around) is not None)
    return score - DOUBT * (DOUBTS.search(around) is not None)


def more_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans the method adds; none of them overlaps a base span or one of an earlier kind."""
    if _HAS_DIGIT.search(text) is None:
        return []
    proposals = [("iban", *span, True) for span in ibans(text)]
    if WORDS["id_number"].search(text):
        proposals += [("id_number", *m.span(), False) for m in _ID.finditer(text) if 9 <= len(_digits(m[0])) <= 12]
    if "AKIA" in text or WORDS["secret"].search(text):
        proposals += [
            ("secret", *m.span(), m[0].startswith("AKIA") or _KEY.search(text[max(0, m.start() - NEAR):m.start()]) is not None)
            for m in _SECRET.finditer(text) if _HAS_DIGIT.search(m[0])
        ]
    found: list[tuple[int, int, str]] = []
    taken = bytearray(len(text) if proposals else 0)
    for start, end, _ in base if proposals else ():
        taken[start:end] = b"\1" * (end - start)
    for kind, start, end, checked in proposals:
        if _score(kind, text, start, end, checked) < KEEP:
            continue
        if taken.find(1, start, end) < 0:
            found.append((start, end, kind))
            taken[start:end] = b"\1" * (end - start)
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def _masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    parts, at = [], 0
    for start, end, kind in sorted(spans):
        if end <= at:
            continue
        parts += [text[at:max(at, start)], f"<{kind}>"]
        at = end
    return "".join([*parts, text[at:]])


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, base_spans and spans (``kind:start:end`` lists)."""
    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def scan(batches):
        for batch in batches:
            found, every = [], []
            for body in batch["text"].to_pylist():
                body = body or ""
                base = base_spans(body)
                found.append(joined(base))
                every.append(joined(base + more_spans(body, base)))
            texts = [pa.array(x, pa.string()) for x in (found, every)]
            yield pa.RecordBatch.from_arrays([batch["key"], *texts], ["key", "base_spans", "spans"])

    kind = picked.schema["key"].dataType.simpleString()
    return picked.mapInArrow(scan, f"key {kind}, base_spans string, spans string").withColumnRenamed("key", key)


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets."""

    @F.pandas_udf("string")
    def replaced(bodies: pd.Series) -> pd.Series:
        def one(body):
            if not body:
                return body
            base = base_spans(body)
            found = base + more_spans(body, base)
            return _masked(body, found) if found else body

        return bodies.map(one)

    return docs.withColumn(text, replaced(F.col(text)))


def digest(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, hash of the base spans, and all spans."""
    def count(kind: str):
        found = F.filter(F.split("base_spans", ","), lambda s: s.startswith(f"{kind}:"))
        return F.size(found).cast("long").alias(f"n_{kind}")

    return spans.select(
        key,
        *map(count, BASE),
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
    )
