"""Base personal-data patterns, found in time linear in the text.

Each pattern is looked for only around a byte it must have, and no start is
tried twice, so texts of one endless word cost no more than others. Spans are
byte offsets into UTF-8; ``code_points`` turns them into code points.
"""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")
#: The stated patterns, the email's in two halves about the at sign.
LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(rb"[0-9][0-9.]*")
IP = re.compile(rb"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = bytes(b for b in range(256) if not 48 <= b <= 57)


def emails(text: bytes) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find(b"@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find(b"@", max(at + 1, done))
    return out


def ips(text: bytes) -> list[tuple[int, int]]:
    runs = [m.span() for m in DOTTED.finditer(text) if text.count(b".", *m.span()) >= 3]
    return [m.span() for a, b in runs for m in IP.finditer(text, a, b) if all(len(p.lstrip(b"0")) <= 3 and int(p.lstrip(b"0") or b"0") <= 255 for p in m.group().split(b"."))]


def luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d -= 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def cards(text: bytes) -> list[tuple[int, int]]:
    out = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().translate(None, NOT_DIGIT)
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: bytes) -> list[tuple[int, int]]:
    if b"+" not in text:
        return []
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(m.group().translate(None, NOT_DIGIT)) <= 15]


def base_spans(text: bytes) -> dict[str, list[tuple[int, int]]]:
    return {"email": emails(text), "ip": ips(text), "card": cards(text), "phone": phones(text)}


def code_points(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same spans in code points; one walk over the text."""
    if not spans or text.isascii():
        return spans
    ends = sorted({x for s in spans for x in s})
    place, count, at = {}, 0, 0
    for x in ends:
        count += len(text[at:x].decode("utf-8", "replace"))
        place[x], at = count, x
    return [(place[a], place[b]) for a, b in spans]


def written(spans: dict[str, list[tuple[int, int]]]) -> str:
    """kind:start:end by kind as listed, then by start, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))
