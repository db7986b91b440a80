"""Cut a text where a byte-level tokenizer can be run on the parts one by one.

The public pattern lets white space belong to what follows it and never lets a match run
from other characters into white space. So a run of white space with the run of other
characters after it is encoded alike alone and in its text, and equal units of a batch
need encoding once. Texts with white space beyond ASCII's six characters are one unit.
"""

from __future__ import annotations

import re

_RARE_SPACE = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]")
_UNIT = re.compile(r"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")


def text_units(text: str) -> list[str]:
    if not text:
        return []
    if _RARE_SPACE.search(text):
        return [text]
    return _UNIT.findall(text)
