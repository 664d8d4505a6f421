"""Words of whole texts as bytes: runs of ASCII letters and digits, A-Z lower-cased, and of everything beyond ASCII."""

from __future__ import annotations

import numpy as np

SPACE = 32
#: Byte -> byte of a word, or a space; one for one, so places in text and table agree.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else SPACE for b in range(256))


def joined(text: str | None) -> bytes:
    """The words of a text with one space between them; a null text has none."""
    return b" ".join((text or "").encode().translate(TABLE).split())


def places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word in the UTF-8 of a text."""
    inside = np.frombuffer(text.translate(TABLE), np.uint8) != SPACE
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]
