"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# trim() alone removes spaces only. What Unicode calls white space, tabs, line ends and non-breaking
# spaces among it, and the four ASCII separators count as edges too. A list of them is trimmed in a small
# part of the time that a regular expression takes to look for them at every place of the text.
_EDGES = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def normalized(value: Column | str, missing_word: str | None = None) -> Column:
    """Lower case without white space at either end.

    With `missing_word` a NULL becomes that word, otherwise it stays NULL.
    """
    value = F.col(value) if isinstance(value, str) else value
    value = F.btrim(F.lower(value), F.lit(_EDGES))
    return value if missing_word is None else F.coalesce(value, F.lit(missing_word))
