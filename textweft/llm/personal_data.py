"""Personal data in text: patterns propose, checksums confirm, nearby words decide.

Each kind's pattern proposes spans. E-mail addresses, IP addresses, card and phone numbers
stand once their own test holds (parts up to 255, the Luhn sum, the number of digits).
Account numbers (IBAN) are confirmed by their mod-97 checksum and national identity numbers
by their shape; both get a score that nearby context words raise, and stay from
``THRESHOLD`` on. Added kinds never remove a span of the four base kinds, and never overlap
one. Every search is linear in the length of the text.
"""

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textweft.llm.common import digest, map_columns

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "secret")
THRESHOLD = 0.5
REACH = 48  # code points before and after a span in which context words count

Span = tuple[int, int]
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_PIECE = re.compile(r"\x20?[A-Z0-9]{1,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?i:token|secret|password|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9_\-+/]{16,})")
_IBAN_LENGTHS = (
    "NO15 BE16 DK18 FI18 FO18 GL18 NL18 MK19 SI19 AT20 BA20 EE20 KZ20 LT20 LU20 XK20 CH21 HR21 LI21 LV21 BG22 BH22 CR22 DE22 "
    "GB22 GE22 IE22 ME22 RS22 VA22 AE23 GI23 IL23 IQ23 TL23 AD24 CZ24 ES24 MD24 PK24 RO24 SA24 SE24 SK24 TN24 VG24 LY25 PT25 "
    "ST25 IS26 TR26 FR27 GR27 IT27 MC27 MR27 SM27 AL28 AZ28 BY28 CY28 DO28 GT28 HU28 LB28 PL28 SV28 BR29 EG29 PS29 QA29 UA29 "
    "JO30 KW30 MU30 MT31 SC31 LC32"
)
IBAN_LENGTHS = {code[:2]: int(code[2:]) for code in _IBAN_LENGTHS.split()}
CONTEXT = {
    "iban": re.compile(r"(?i)iban|account|konto|compte|cuenta|bank|banque|banco|bic|swift"),
    "ssn": re.compile(r"(?i)ssn|social|security|sozialversicherung|s[ée]curit[ée]|seguridad"),
}


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        value = int(d) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[Span]:
    """Matches of local part, ``@`` and dotted domain, found from each ``@``.

    A match holds one ``@`` with the longest run before it that no earlier match took.
    """
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[Span]:
    """Four dotted numbers at a time from the left of each dotted run, each at most 255."""
    if "." not in text:
        return
    for run in _DOTTED.finditer(text):
        if run[0].count(".") < 3:
            continue
        parts, start = run[0].split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                yield start, end
            start = end + 1


def cards(text: str) -> Iterator[Span]:
    for run in _CARD.finditer(text):
        if run.end() - run.start() >= 13:
            digits = run[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield run.span()


def phones(text: str) -> Iterator[Span]:
    if "+" not in text:
        return
    for run in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in run[0]) <= 15:
            yield run.span()


def _account_ends(text: str, head: re.Match) -> Iterator[tuple[int, int]]:
    """``(length, end)`` after each piece that follows the head, from 15 to 34 characters without spaces."""
    at, length = head.end(), 4
    while piece := _IBAN_PIECE.match(text, at):
        at, length = piece.end(), length + len(piece[0].lstrip(" "))
        if length > 34:
            return
        if length >= 15:
            yield length, at


def _confirmed(text: str, low: int, high: int, sure: bool) -> Iterator[Span]:
    head = _IBAN_HEAD.search(text, low, high)
    while head:
        start, known = head.start(), IBAN_LENGTHS.get(head[0][:2])
        ends = [e for length, e in _account_ends(text, head) if e <= high and (length == known or not sure)]
        end = next((e for e in reversed(ends) if mod97(text[start:e].replace(" ", ""))), None)
        if end:
            yield start, end
        head = _IBAN_HEAD.search(text, end or head.end(), high)


def accounts(text: str) -> Iterator[Span]:
    """Account numbers among what starts like one, each cut where its checksum holds.

    Upper-case words and numbers may follow without belonging to it. So numbers of their
    country's length come first, and between these the longest run of pieces that the
    checksum confirms. The search goes on behind a number, or behind the start of a failed one.
    """
    done = 0
    for start, end in [*_confirmed(text, 0, len(text), True), (len(text), len(text))]:
        yield from _confirmed(text, done, start, False)
        if start < end:
            yield start, end
        done = end


def score(kind: str, text: str, span: Span) -> float:
    """Confidence before context, raised by a context word within reach."""
    base = {"iban": 0.6, "ssn": 0.3, "secret": 0.8}[kind]
    words = CONTEXT.get(kind)
    near = words and words.search(text[max(0, span[0] - REACH) : span[1] + REACH])
    return min(1.0, base + (0.35 if near else 0.0))


def added_spans(text: str) -> Iterator[tuple[str, Span]]:
    for span in accounts(text):
        yield "iban", span
    if "-" in text:
        for found in _SSN.finditer(text):
            yield "ssn", found.span()
    if "=" in text or ":" in text:
        for found in _SECRET.finditer(text):
            yield "secret", found.span(1)


def find_spans(text: str) -> dict[str, list[Span]]:
    """Spans by kind, in code points, end exclusive, from left to right."""
    found: dict[str, list[Span]] = {
        "email": list(emails(text)),
        "ip": list(addresses(text)),
        "card": list(cards(text)),
        "phone": list(phones(text)),
    }
    taken = sorted(span for spans in found.values() for span in spans)
    for kind in KINDS[len(BASE) :]:
        found[kind] = []
    for kind, span in added_spans(text):
        if score(kind, text, span) >= THRESHOLD and not any(s < span[1] and span[0] < e for s, e in taken):
            found[kind].append(span)
    return found


def joined(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in kinds for s, e in sorted(found[k]))


def redacted(text: str, found: dict[str, list[Span]]) -> str:
    """The text with each span, or each union of overlapping spans, replaced by its kind."""
    parts, done = [], 0
    spans = sorted((s, -e, k) for k, each in found.items() for s, e in each)
    for start, end, kind in spans:
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, -end)
    return "".join(parts) + text[done:]


OUTPUTS = {
    **{f"n_{k}": T.LongType() for k in KINDS},
    "base_sha256": T.StringType(),
    "spans": T.StringType(),
    "redacted": T.StringType(),
}
DIGEST = (*(f"n_{k}" for k in BASE), "base_sha256", "spans")


def find_personal_data(
    docs: DataFrame, outputs: tuple[str, ...] = tuple(OUTPUTS), text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add ``outputs`` worked out from each row's whole text.

    ``n_<kind>`` counts spans, ``spans`` lists all as ``kind:start:end`` by kind and start,
    ``base_sha256`` is the digest of that list for the four base kinds, and ``redacted`` the
    text with every span replaced by its kind. A null text has no spans and stays null in
    ``redacted``; an empty one stays empty. Rows are judged one by one, so repeated rows
    stay repeated; a column with an output's name is replaced.
    """
    adds = T.StructType([T.StructField(name, OUTPUTS[name]) for name in outputs])

    def work(columns: dict[str, list]) -> dict[str, list]:
        got: dict[str, list] = {name: [] for name in outputs}
        for value in columns[text]:
            found = find_spans(value or "")
            for name in outputs:
                if name == "base_sha256":
                    got[name].append(digest(joined(found, BASE)))
                elif name == "spans":
                    got[name].append(joined(found, KINDS))
                elif name == "redacted":
                    got[name].append(value and redacted(value, found))
                else:
                    got[name].append(len(found[name[2:]]))
        return got

    return map_columns(docs, [text], adds, work, keep)
