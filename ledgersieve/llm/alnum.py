"""Words of letters and digits: runs outside `[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z were lowered."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ledgersieve.llm.words import Words, split_words, text_bytes

_CODES = np.arange(256)
_IS_GAP = (_CODES < 128) & ~((_CODES >= 48) & (_CODES <= 57)) & ~((_CODES >= 97) & (_CODES <= 122))
_LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
# The same as a byte table: letters lowered, everything between words a space.
SPACED = np.where(_IS_GAP[_LOWER], 32, _LOWER).astype(np.uint8).tobytes()


def alnum_words(texts: pa.Array) -> Words:
    """The words of a text column, lowered; NULL has none."""
    data, offsets = text_bytes(texts)
    return split_words(_LOWER[data], offsets, _IS_GAP)


def plain_words(text: str) -> list[str]:
    """The words of one text, for short texts such as patterns."""
    return [w.decode() for w in text.encode().translate(SPACED).split(b" ") if w]
