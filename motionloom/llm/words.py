"""Words of a text without letter case, accents, punctuation, markup, quoting and spacing."""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np
import xxhash

_TAG = re.compile(r"</?[A-Za-z][^<>]{0,200}>|<!--.*?-->", re.S)
_WORD = re.compile(r"[^\W_]+")
_PLAIN = re.compile(r"[\x00-\x7f]*\Z")
_IDS: dict[str, int] = {}
_MOST_IDS = 2_000_000


def plain_words(text: str | None) -> list[str]:
    """The words of a text; null and blank texts have none."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if not _PLAIN.match(text):
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
    return _WORD.findall(text.casefold())


def word_ids(words: list[str]) -> np.ndarray:
    """64-bit hashes of words."""
    if len(_IDS) > _MOST_IDS:  # a cache, so forgetting it changes nothing
        _IDS.clear()
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = _IDS.get(w)
        if h is None:
            h = _IDS[w] = xxhash.xxh64_intdigest(w)
        out[i] = h
    return out
