"""URL slugs from names, without leaving the JVM."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(characters, replacements) for `translate`: accented letters, then marks to delete.

    Only characters that reduce to one ASCII letter or digit matter, since a slug drops the rest;
    nonspacing marks come last and have no partner, which makes `translate` remove them.
    """
    letters, bases, marks = [], [], []
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        if unicodedata.category(char) == "Mn":
            marks.append(char)
            continue
        base = [c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"]
        if len(base) == 1 and base[0].isascii() and base[0].isalnum():
            letters.append(char)
            bases.append(base[0])
    return "".join(letters + marks), "".join(bases)


def slugify(text: Column) -> Column:
    """Lower-case ASCII words joined by single dashes; NULL stays NULL."""
    accented, plain = accent_table()
    # Equal length in characters and in bytes means pure ASCII, which needs no translation.
    is_ascii = F.length(text) == F.octet_length(text)
    base = F.when(is_ascii, text).otherwise(F.translate(text, accented, plain))
    return F.btrim(F.regexp_replace(F.lower(base), "[^a-z0-9]+", "-"), F.lit("-"))
