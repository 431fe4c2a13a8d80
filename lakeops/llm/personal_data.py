"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import map_texts, own_columns

#: Kinds in the order of spans that start together: the base kinds first, then those the method adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "local_phone", "secret")
KINDS = BASE + ADDED

# Lengths of the account numbers of the ISO 13616 registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22,
    "VG": 24, "XK": 20,
}

# The base patterns. Each is written so that it cannot start again inside what it has tried, which keeps it linear
# on long runs: a run of digits or of address characters is tried from its first character only.
_AT = re.compile("@")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+().-])(?<!\) )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])")

#: A credential: a name of one, a sign, and a value; or a value whose shape alone says so.
_NAMED = ("token", "secret", "passw", "api_key", "apikey", "api-key", "access_key", "access-key", "credential")
_SECRET = re.compile(r"""(?i)(?:token|secret|passwo?r?d|api[_-]?key|access[_-]?key|credentials?)["']?\s{0,3}[=:]\s{0,3}["']?([A-Za-z0-9+/_.-]{12,}+)""")
_SHAPED = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[oprsu]_[A-Za-z0-9]{36,255})(?![A-Za-z0-9])")
#: Bits of entropy a character that a value needs to count as drawn at random.
LEAST_BITS = 3.0

#: Words that raise a span's score when they stand within CONTEXT characters of it, by kind.
CONTEXT_WORDS = {
    "email": ("mail", "contact", "correo", "courriel"), "ip": ("ip", "host", "server", "address", "adresse"), "card": ("card", "credit", "visa", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "telefon", "fax"), "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"), "local_phone": ("phone", "call", "tel", "mobile", "telefon", "fax"), "secret": ("auth", "login", "bearer", "private"),
}
CONTEXT = 40
#: Score of a match of the pattern, what a passed check adds and what a context word adds. An added span must reach LEAST.
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.3, "phone": 0.6, "iban": 0.3, "ssn": 0.3, "local_phone": 0.3, "secret": 0.3}
CHECKED, IN_CONTEXT, LEAST = 0.5, 0.3, 0.6


@dataclass(frozen=True)
class Span:
    """Code points ``start`` to ``end`` (exclusive) of a text."""

    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Country, check digits and account of an ISO 13616 number: moved to the end and read as a number, 1 modulo 97."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def entropy_bits(value: str) -> float:
    """Shannon entropy of the value's characters, in bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_random(value: str) -> bool:
    """The check on secrets: letters and digits mixed, of ``LEAST_BITS`` a character."""
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and entropy_bits(value) >= LEAST_BITS


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from their @."""
    done = 0
    for at in _AT.finditer(text):
        start = at.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if done <= start < at.start() and (domain := _DOMAIN.match(text, at.start())):
            yield start, domain.end()
            done = domain.end()


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _proposed(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, confirmed by a check) of all spans that their kind allows."""
    for start, end in emails(text):
        yield "email", start, end, False
    if "." in text:
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                yield "ip", *m.span(), False
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", *m.span(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span(), False
    for m in _IBAN.finditer(text):
        account = m[0].replace(" ", "")
        # The pattern may run on into words in capitals: the country's length says where the number ends.
        if (length := IBAN_LENGTHS.get(account[:2])) and len(account) >= length:
            end, seen = m.start(), 0
            while seen < length:
                seen += text[end] != " "
                end += 1
            if (end == len(text) or not text[end].isalnum()) and mod97(account[:length]):
                yield "iban", m.start(), end, True
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", *m.span(), False
    for m in _LOCAL_PHONE.finditer(text):
        yield "local_phone", *m.span(), False
    low = text.lower() if "=" in text or ":" in text else ""
    named = [m.span(1) for m in _SECRET.finditer(text)] if any(name in low for name in _NAMED) else []
    ends = {end for _, end in named}
    shaped = [m.span() for m in _SHAPED.finditer(text) if m.end() not in ends] if "AKIA" in text or "gh" in text else []
    for start, end in named + shaped:
        yield "secret", start, end, looks_random(text[start:end])


_WORD = re.compile(r"[^\W\d_]+")


def find_personal_data(text: str) -> list[Span]:
    """Spans by start and then in the order of ``KINDS``; base kinds always, added ones from a score of ``LEAST``.

    An added span that a check has confirmed stays beside base ones that it overlaps; another one is left out where it does.
    """
    out: list[Span] = []
    base: list[tuple[int, int]] = []
    for kind, start, end, confirmed in _proposed(text):
        score = SCORES[kind] + CHECKED * confirmed
        near = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
        if any(w.lower() in CONTEXT_WORDS[kind] for w in _WORD.findall(near)):
            score += IN_CONTEXT
        if kind in BASE:
            base.append((start, end))
        elif score < LEAST or not confirmed and any(a < end and start < b for a, b in base):
            continue
        out.append(Span(kind, start, end, min(1.0, score)))
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; spans that overlap are replaced together, by the kind of the first."""
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at : s.start], f"<{s.kind}>"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))


def personal_data(documents: DataFrame, mask: bool = False) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans, n_secret, found) for each row of ``documents``, and ``masked_text`` if asked for.

    The first counts and the hash are of the base kinds, ``spans``, their number and ``found`` (with scores) of all. A NULL text counts as empty: no spans. Repeated
    rows are searched each. Texts are searched whole, one at a time.
    """

    def work(raw: list[bytes]) -> dict:
        texts = [t.decode("utf-8", "replace") for t in raw]
        found = [find_personal_data(t) for t in texts]
        base = [[s for s in spans if s.kind in BASE] for spans in found]
        out = {f"n_{k}": [sum(s.kind == k for s in spans) for spans in base] for k in BASE}
        out["base_sha256"] = [hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base]
        out["spans"] = [joined(spans) for spans in found]
        out["n_spans"] = [len(spans) for spans in found]
        out["n_secret"] = [sum(s.kind == "secret" for s in spans) for spans in found]
        out["found"] = [[{"kind": s.kind, "start": s.start, "end": s.end, "score": s.score} for s in spans] for spans in found]
        if mask:
            out["masked_text"] = [masked(t, s) for t, s in zip(texts, found, strict=True)]
        return out

    adds = [*[(f"n_{k}", T.LongType()) for k in BASE], ("base_sha256", T.StringType()), ("spans", T.StringType()), ("n_spans", T.LongType()), ("n_secret", T.LongType()), ("found", SPAN_TYPE)]
    return map_texts(own_columns(documents, "doc_id", "text"), work, [*adds, *([("masked_text", T.StringType())] if mask else [])])
