"""Brahmic scripts to Latin, and the letters of phonetic keys.

The Brahmic blocks are laid out alike, so one table by offset serves all. A text is read as a sequence of signs; a
consonant's inherent vowel is written when the next sign of the same word asks for it, and dropped at a word's end."""

from __future__ import annotations

import unicodedata

# Latin forms by offset in a block.
CONSONANTS = {
    0x15: "k", 0x16: "kh", 0x17: "g", 0x18: "gh", 0x19: "n", 0x1A: "ch", 0x1B: "chh", 0x1C: "j", 0x1D: "jh", 0x1E: "n",
    0x1F: "t", 0x20: "th", 0x21: "d", 0x22: "dh", 0x23: "n", 0x24: "t", 0x25: "th", 0x26: "d", 0x27: "dh", 0x28: "n",
    0x29: "n", 0x2A: "p", 0x2B: "ph", 0x2C: "b", 0x2D: "bh", 0x2E: "m", 0x2F: "y", 0x30: "r", 0x31: "r", 0x32: "l",
    0x33: "l", 0x34: "l", 0x35: "v", 0x36: "sh", 0x37: "sh", 0x38: "s", 0x39: "h", 0x58: "q", 0x59: "kh", 0x5A: "g",
    0x5B: "z", 0x5C: "r", 0x5D: "rh", 0x5E: "f", 0x5F: "y",
}
VOWELS = {
    0x05: "a", 0x06: "aa", 0x07: "i", 0x08: "ii", 0x09: "u", 0x0A: "uu", 0x0B: "ri", 0x0C: "li", 0x0D: "e", 0x0E: "e",
    0x0F: "e", 0x10: "ai", 0x11: "o", 0x12: "o", 0x13: "o", 0x14: "au", 0x60: "rii", 0x61: "lii",
}
VOWEL_SIGNS = {
    0x3E: "aa", 0x3F: "i", 0x40: "ii", 0x41: "u", 0x42: "uu", 0x43: "ri", 0x44: "rii", 0x45: "e", 0x46: "e", 0x47: "e",
    0x48: "ai", 0x49: "o", 0x4A: "o", 0x4B: "o", 0x4C: "au", 0x57: "au", 0x62: "li", 0x63: "lii",
}
NUKTA_FORMS = {"ph": "f", "j": "z", "k": "q", "d": "r", "dh": "rh", "kh": "kh", "g": "g"}
LABIALS = {"p", "ph", "b", "bh", "m", "f"}
CHILLU = {0x0D7A: "n", 0x0D7B: "n", 0x0D7C: "r", 0x0D7D: "l", 0x0D7E: "l", 0x0D7F: "k"}
NASALS, VISARGA, NUKTA, VIRAMA, RRA = (0x01, 0x02), 0x03, 0x3C, 0x4D, 0x0D31
OCR_DIGITS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SOUNDS_AS = {"c": "k", "q": "k", "z": "j", "g": "j", "w": "v"}


def _brahmic(c: str) -> bool:
    return "ऀ" <= c <= "෿"


def _sign(c: str) -> tuple[str, str]:
    """Class and Latin form of a character."""
    if ord(c) in CHILLU:
        return "closed", CHILLU[ord(c)]
    if not _brahmic(c):
        return "other", c
    if unicodedata.category(c) == "Nd":
        return "other", str(unicodedata.digit(c))
    at = ord(c) & 0x7F
    for kind, forms in (("consonant", CONSONANTS), ("vowel sign", VOWEL_SIGNS), ("closed", VOWELS)):
        if at in forms:
            return kind, forms[at]
    return {NUKTA: ("nukta", ""), VIRAMA: ("virama", ""), VISARGA: ("closed", "h")}.get(at, ("nasal", "") if at in NASALS else ("closed", ""))


def to_latin(text: str) -> str:
    """Brahmic characters in Latin letters; others stay, zero-width joiners go."""
    out: list[str] = []
    open_ = False  # the last sign was a consonant without a vowel so far
    for k, c in enumerate(text):
        if c in "‌‍":
            continue
        kind, form = _sign(c)
        if open_ and kind in ("consonant", "closed", "nasal"):
            out.append("a")
        if kind == "nasal":
            after = text[k + 1] if k + 1 < len(text) and _brahmic(text[k + 1]) else ""
            form = "m" if not after or CONSONANTS.get(ord(after) & 0x7F) in LABIALS else "n"
        if kind == "nukta":
            if out:
                out[-1] = NUKTA_FORMS.get(out[-1], out[-1])
            continue
        if kind == "consonant" and k >= 2 and ord(c) == ord(text[k - 2]) == RRA and ord(text[k - 1]) & 0x7F == VIRAMA:
            out[-1] = form = "t"
        out += [form] * bool(form)
        open_ = kind == "consonant"
    return "".join(out)
