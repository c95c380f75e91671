"""Words of a text, apart from its dress."""

from __future__ import annotations

import html
import re
import unicodedata

_CJK = "㐀-䶿一-鿿豈-﫿"
_ASCII = re.compile(r"[a-z0-9]+")
_ANY = re.compile(f"[{_CJK}]|[^\\W_{_CJK}]+")
_HIDDEN = re.compile("[­​-‏‪-‮⁠-⁤﻿︀-️]")
_TAG = re.compile(r"</?(?:b|i|u|em|strong|span|a|code|sup|sub|small|mark|font)\b[^<>]*>", re.I)
_BLOCK = re.compile(r"<(?:/?[a-z][^<>]*|!--.*?--)>", re.I | re.S)
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})")
_PERCENT = re.compile(r"(?:%[0-9a-fA-F]{2})+")
_BROKEN = re.compile(r"(\w)[-‐‑]\s*\n\s*(\w)")
_ODD = re.compile("[&<\\\\%­​-‏‪-‮⁠-⁤﻿︀-️]|[-‐‑]\\s*\n")


def fold(text: str) -> str:
    """Compatibility forms, case and accents removed."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text).casefold())
    return "".join(c for c in text if not unicodedata.combining(c)) if not text.isascii() else text


def words(text: str) -> list[str]:
    """Folded words; each ideograph is a word. Punctuation and blanks only separate."""
    text = fold(text)
    return _ASCII.findall(text) if text.isascii() else _ANY.findall(text)


def _percent(m: re.Match) -> str:
    try:
        return bytes.fromhex(m.group().replace("%", "")).decode("utf-8")
    except UnicodeDecodeError:
        return m.group()


def undress(text: str) -> str:
    """Text without markup, escapes, invisible characters and hyphenation at line ends."""
    if not _ODD.search(text):
        return text
    text = _HIDDEN.sub("", text)
    if "\\" in text:
        text = _ESCAPE.sub(lambda m: chr(int(m.group(1), 16)), text)
        text = text.replace("\\n", "\n").replace("\\r", " ").replace("\\t", " ").replace('\\"', '"').replace("\\/", "/")
    if "%" in text:
        text = _PERCENT.sub(_percent, text)
    if "&" in text:
        text = html.unescape(html.unescape(text))
    if "<" in text:
        text = _BLOCK.sub(" ", _TAG.sub("", text))
    return _BROKEN.sub(r"\1\2", _HIDDEN.sub("", text))


def plain_words(text: str) -> list[str]:
    """words() of the undressed text."""
    return words(undress(text))
