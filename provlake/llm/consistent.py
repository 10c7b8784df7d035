"""One consistent form for text that reads the same (problem 3).

Confusables skeleton: decompose, replace every character by the prototype of
its look-alike class, decompose again.  Two texts look the same exactly if
their skeletons are equal.

What is folded: full-width and narrow forms, joined letters, composed against
combining accents, characters without width, spaces of another kind, and
letters and hyphens that look alike in another script.  What stays apart:
accents, strokes, raised or lowered digits, marks, case, tabs and line breaks.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

# Letters and hyphens of other scripts or blocks that are drawn
# like a Latin letter or the ASCII hyphen, each with its prototype.
LOOK_ALIKES = {
    # Cyrillic, small
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "ӏ": "l", "ѵ": "v", "ү": "y", "ґ": "r",
    # Cyrillic, capital
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I",
    "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ӏ": "I", "Ѵ": "V",
    # Greek, small
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u",
    "χ": "x", "γ": "y", "ϲ": "c", "ϳ": "j",
    # Greek, capital
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "Ϲ": "C", "Ϳ": "J",
    # Armenian, Latin variants
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "Օ": "O", "Ս": "U",
    "ɑ": "a", "ɡ": "g", "ʋ": "v",
    # Hyphens
    "‐": "-", "‑": "-", "−": "-", "⁃": "-", "﹣": "-",
    "˗": "-",
}

#: Compatibility tags whose characters look like what they decompose to.
#: Raised, lowered, circled, fraction and similar forms are visibly different.
FOLDED_TAGS = frozenset({"<wide>", "<narrow>", "<noBreak>", "<small>", "<font>"})

#: Format characters that are drawn: number and verse signs.
_DRAWN_FORMATS = {*range(0x0600, 0x0606), 0x06DD, 0x070F, 0x0890, 0x0891, 0x08E2, 0x110BD, 0x110CD}
_WIDTHLESS_MARKS = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0}


def _joined_letters(ch: str, parts: list[str]) -> bool:
    """A <compat> decomposition into letters only, as of a ligature."""
    return len(parts) > 1 and unicodedata.category(ch) in ("Ll", "Lu", "Lt") and all(unicodedata.category(chr(int(p, 16)))[0] == "L" for p in parts)


@lru_cache(maxsize=1)
def prototype_table() -> dict[int, str | None]:
    """Code point -> prototype, built from the character database by rule.

    Called once per process; only code points that change are held.
    """
    table: dict[int, str | None] = {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF or 0xE000 <= cp <= 0xF8FF or 0x20000 <= cp <= 0x2FFFF or cp >= 0xF0000:
            continue
        ch = chr(cp)
        cat = unicodedata.category(ch)
        if cat == "Cn":
            continue
        if (cat == "Cf" and cp not in _DRAWN_FORMATS) or cp in _WIDTHLESS_MARKS or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF or 0x180B <= cp <= 0x180D:
            table[cp] = None
        elif cat == "Zs":
            table[cp] = " "
        else:
            parts = unicodedata.decomposition(ch).split()
            if parts and parts[0].startswith("<"):
                if parts[0] in FOLDED_TAGS:
                    table[cp] = "".join(chr(int(p, 16)) for p in parts[1:])
                elif parts[0] == "<compat>" and _joined_letters(ch, parts[1:]):
                    table[cp] = unicodedata.normalize("NFKD", ch)
    # prototypes of prototypes: a full-width form of a look-alike, for instance
    for cp, to in list(table.items()):
        if to:
            table[cp] = "".join(LOOK_ALIKES.get(c, c) for c in to)
    table.update({ord(a): b for a, b in LOOK_ALIKES.items()})
    return table


def _replace(text: str) -> str:
    """The look-alike table applied, one pass for each distinct character that it holds."""
    table = prototype_table()
    for ch in set(text).intersection(_held()):
        text = text.replace(ch, table[ord(ch)] or "")
    return text


@lru_cache(maxsize=1)
def _held() -> frozenset[str]:
    return frozenset(map(chr, prototype_table()))


def skeleton(text: str | None) -> str | None:
    """Decomposed prototype form; None stays None, the empty text stays empty."""
    if text is None or text.isascii():
        return text
    return unicodedata.normalize("NFD", _replace(unicodedata.normalize("NFD", text)))


def consistent(text: str | None) -> str | None:
    """The consistent text: the skeleton, composed again so that it can be read."""
    if text is None or text.isascii():
        return text
    return unicodedata.normalize("NFC", skeleton(text))


# ASCII bytes that are no letter or digit become a space.
_BREAK = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of letters and digits of the consistent text, case ignored, as UTF-8."""
    if not text:
        return []
    text = consistent(text).lower()
    if not text.isascii():
        for ch in set(text):
            if ch > "\x7f" and not ch.isalnum():
                text = text.replace(ch, " ")
    return text.encode("utf-8", "ignore").translate(_BREAK).split()
