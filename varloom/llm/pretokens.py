"""Pre-tokens of the SentencePiece model: the units that its pieces never cross.

The normaliser is the identity with a dummy prefix: a space becomes the
mark U+2581 and one mark is put in front. No piece holds a mark after
another character, so the text falls into independent runs ``marks + others``.
A run is named by the text whose encoding it is: the run without its first
mark, marks written as spaces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

MARK = "▁"
_RUN = re.compile(f"{MARK}+[^{MARK}]*")
CHUNK = 1 << 20  # characters split at once


def pretokens(text: str) -> list[str]:
    """Pre-tokens of a text, in order; none for the empty text."""
    if not text:
        return []
    if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
        return [m[1:].replace(MARK, " ") for m in _RUN.findall(MARK + text.replace(" ", MARK))]
    return text.split(" ")


def pretoken_chunks(text: str) -> Iterator[list[str]]:
    """The pre-tokens of a text of any length, in lists of a bounded size.

    Cuts at a single space, which the next part's dummy prefix stands for; a
    run without such a space is taken whole.
    """
    at, n = 0, len(text)
    while n - at > CHUNK:
        cut = at + CHUNK
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or (cut + 1 < n and text[cut - 1] not in " ▁" and text[cut + 1] not in " ▁"):
                break
            cut += 1
        if cut < 0:
            break
        yield pretokens(text[at:cut])
        at = cut + 1
    yield pretokens(text[at:])
