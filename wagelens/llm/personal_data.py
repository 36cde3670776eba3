"""Spans of personal data in a text: e-mail addresses, IP addresses, card and phone numbers.

Each kind is found leftmost and without overlap, in time linear in the text.  Places
are code points, the end not included.
"""

from __future__ import annotations

import re

EMAIL, IP, CARD, PHONE = KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOTTED = re.compile(r"[0-9][0-9.]*")
_FOUR = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """`[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, from each domain back to its local part."""
    out, free = [], 0
    for m in _DOMAIN.finditer(text):
        at = m.start()
        least = max(free, text.rfind("@", free, at) + 1)
        start = least + len(text[least:at].rstrip(_LOCAL))
        if start < at:
            out.append((start, m.end()))
            free = m.end()
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Four numbers with dots between, each at most 255.

    A match begins and ends with whole runs of digits, so only run starts are tried.
    """
    out = []
    for seg in _DOTTED.finditer(text):
        if seg[0].count(".") >= 3:
            for m in _FOUR.finditer(seg[0]):
                parts = [p.lstrip("0") for p in m[0].split(".")]
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                    out.append((seg.start() + m.start(), seg.start() + m.end()))
    return out


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    """14 to 19 digits, single blanks or hyphens between, with a right check digit."""
    out = []
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    """A plus sign and 10 to 15 digits with blanks, brackets, dots and hyphens."""
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m[0])) <= 15]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all kinds, by start, then kind."""
    found = (emails(text) if "@" in text else [], ips(text), cards(text), phones(text))
    return sorted((start, kind, end) for kind, spans in enumerate(found) for start, end in spans)
