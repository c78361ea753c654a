"""Words of a text, as problem 7 counts them, for the operators that compare texts."""

from __future__ import annotations

import re
import unicodedata

_WORD = re.compile(r"[a-z0-9]+")


def words(text: str | None) -> list[str]:
    """Runs of a-z and 0-9 after compatibility normalisation, removal of soft hyphens and lower-casing; [] for null."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).replace("­", "")
    return _WORD.findall(text.lower())
