"""Character tables of the one form, made from the Unicode database by rule.

Every table has a size fixed by Unicode (at most one row per assigned code point), so
broadcasting them is safe at any corpus size.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

# Marks drawn like an apostrophe.
APOSTROPHES = "‘’‛ʻʼʽʹ′‵`´＇｀Ꞌꞌ՚׳ߴߵ᾽᾿´`"

# Letters of other scripts drawn like Latin letters, and those Latin letters.
LOOK_ALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Һ": "H", "Ү": "Y", "Ԍ": "G",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ԍ": "g", "ү": "y", "ӏ": "l", "Ӏ": "I",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "ε": "ɛ", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j",
    "Օ": "O", "օ": "o", "ս": "u", "հ": "h", "ց": "g", "զ": "q",
}

# The typographic Latin ligatures that are two or three ordinary letters side by side.
LIGATURES = range(0xFB00, 0xFB07)

# Marks without a width or shape of their own that Unicode doesn't class as format characters.
MORE_INVISIBLE = [0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]
VISIBLE_FORMAT = [*range(0x0600, 0x0606), 0x06DD, 0x070F, 0x08E2, 0x110BD, 0x110CD]


def _invisible(cp: int) -> bool:
    kind = unicodedata.category(chr(cp))
    return kind == "Cf" and cp not in VISIBLE_FORMAT or kind == "Cc" and not chr(cp).isspace() or cp in MORE_INVISIBLE


def _mapped(ch: str) -> str:
    """The character decomposed and brought to ordinary width, with plain apostrophes."""
    if ch in APOSTROPHES:
        return "'"
    tag, _, rest = unicodedata.decomposition(ch).partition(" ")
    if tag in ("<wide>", "<narrow>") or ord(ch) in LIGATURES and tag:
        return "".join(_mapped(chr(int(x, 16))) for x in rest.split())
    return unicodedata.normalize("NFD", ch)


@lru_cache(1)
def pairs() -> dict[tuple[str, str], str]:
    """First and second character to the composed one, for every pair that NFC composes."""
    out = {}
    for cp in range(0xA0, sys.maxunicode + 1):
        ch = chr(cp)
        d = unicodedata.decomposition(ch)
        if d and d[0] != "<" and " " in d and unicodedata.normalize("NFC", ch) == ch:
            a, b = (chr(int(x, 16)) for x in d.split())
            out[a, b] = ch
    return out


def compose(chars: list[str]) -> str:
    """Recompose canonically ordered characters: each mark joins the last starter unless one of
    the same or a zero class stands between. Hangul joins by its arithmetic."""
    table, out, starter, last = pairs(), [], -1, 0
    for ch in chars:
        kind = unicodedata.combining(ch)
        if starter >= 0 and (len(out) - 1 == starter or 0 < last < kind):
            a, b = ord(out[starter]), ord(ch)
            if 0x1100 <= a < 0x1113 and 0x1161 <= b < 0x1176:
                joined = chr(0xAC00 + ((a - 0x1100) * 21 + b - 0x1161) * 28)
            elif 0xAC00 <= a < 0xD7A4 and (a - 0xAC00) % 28 == 0 and 0x11A7 < b < 0x11C3:
                joined = chr(a + b - 0x11A7)
            else:
                joined = table.get((out[starter], ch))
            if joined:
                out[starter] = joined
                continue
        out.append(ch)
        last = kind
        if kind == 0:
            starter = len(out) - 1
    return "".join(out)


@lru_cache(1)
def rows() -> list[tuple]:
    """``(cp, [(character, class, look-alike, kind, second)])`` of each code point that isn't simply
    itself. kind: 1 Latin letter, 2 letter of another script that no Latin one looks like, 3 blank,
    4 letter that has a Latin look-alike. second: it may compose with what stands before it."""
    seconds = {b for _, b in pairs()} | {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    out = []
    for cp in range(sys.maxunicode + 1):
        ch = chr(cp)
        kind = unicodedata.category(ch)
        if kind in ("Cn", "Cs", "Co"):
            continue
        if ch.isspace():
            out.append((cp, [(" ", 0, None, 3, False)]))
        elif _invisible(cp):
            out.append((cp, []))
        else:
            row = []
            for c in _mapped(ch):
                look = LOOK_ALIKES.get(c)
                latin = c.isalpha() and unicodedata.name(c, "").startswith("LATIN")
                row.append((c, unicodedata.combining(c), look, 4 if look else 1 if latin else 2 if c.isalpha() else 0, c in seconds))
            if "".join(r[0] for r in row) != ch or any(r[1] or r[2] or r[3] == 1 or r[4] for r in row):
                out.append((cp, row))
    return out


def _ranges(cps) -> str:
    cps, out = sorted(cps), []
    for cp in cps:
        if out and out[-1][1] == cp - 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return "".join(f"\\x{{{a:X}}}" + (f"-\\x{{{b:X}}}" if b > a else "") for a, b in out)


@lru_cache(1)
def patterns() -> tuple[str, ...]:
    """Java patterns ``(far, changed_far, changed_near, moved_near, moved_far)``: a text needs work only if it holds
    a character to be changed or a mark that may have to be moved or composed. Those past U+036F are looked
    for only in texts with characters past U+036F, so ordinary Latin text is passed over at the cost
    of a few small classes."""
    changed, marks = set(map(ord, LOOK_ALIKES)), set()
    for cp, row in rows():
        ch = chr(cp)
        if any(r[1] or r[4] for r in row) and len(row) == 1 and row[0][0] == ch:
            marks.add(cp)
        elif ch != " " and ch not in "\t\n\r" and (compose([r[0] for r in row]) != ch or any(r[2] for r in row)):
            changed.add(cp)
    firsts = {ord(a) for a, _ in pairs()} | marks | {*range(0x1100, 0x1113), *range(0xAC00, 0xD7A4, 28)}
    for cp, row in rows():  # a composed letter may take part of a later mark: what it is made of decides
        if len(row) > 1 or row and row[0][0] != chr(cp):
            firsts.add(cp)
    # Java tries the ranges of a class one by one, so each class stands behind a test of one or two ranges
    below = [c for c in changed if c < 0x370]
    assert all(c < 0x20 or c in (0x60, 0x7F) or chr(c).encode()[0] in (0xC2, 0xCA, 0xCD) for c in below)
    idle = [c for c in range(0x250, 0x2B0) if c not in firsts]  # letters with tone marks that never compose
    latin = [c for c in firsts if c < 0x250 or 0x300 <= c < 0x370 or 0x1E00 <= c < 0x1F00]
    rest = [c for c in firsts if c not in set(latin)]
    low = rf"[\u0300-\u036F](?<![{_ranges(idle)}].)(?:(?<=[\u0000-\u036F\u1E00-\u1EFF].)(?<=[{_ranges(latin)}].)|(?<=[\u0370-\u1DFF\u1F00-\x{{10FFFF}}].)(?<=[{_ranges(rest)}].))"
    high = rf"(?=[\u0370-\x{{10FFFF}}])[{_ranges(m for m in marks if m > 0x36F)}](?<=[{_ranges(firsts)}].)"
    # the low marks lie between the letters and the rest; the second pattern of each pair decides
    return rf"[^\x00-\u036F]", rf"(?=[^\x00-\u036F])[{_ranges(c for c in changed if c >= 0x370)}]", f"[{_ranges(below)}]", low, high
