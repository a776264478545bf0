"""Text keys, names, redaction and numbers found in text."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folded() -> tuple[dict[str, str], dict[str, str]]:
    """Letters and figures whose Unicode compatibility decomposition holds ASCII: those of one such letter, and those of several."""
    one, several = {}, {}
    for code in (*range(0x00A0, 0x0250), *range(0x1D00, 0x1F00), *range(0x2000, 0x2500), *range(0xFB00, 0xFB07), *range(0xFF00, 0xFFF0)):
        letter = chr(code)
        plain = unicodedata.normalize("NFKD", letter).encode("ascii", "ignore").decode()
        if plain and letter == letter.lower():
            (one if len(plain) == 1 else several)[letter] = plain
    return one, several


ONE, SEVERAL = _folded()
ACCENTED, PLAIN = "".join(ONE), "".join(ONE.values())

# What counts as an address, and what is put in its place.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
EMAIL_MASK = "[email]"

NUMBER = r"[0-9]+(?:[.,][0-9]+)?"


def fold_accents(text: Column) -> Column:
    """Lower case, with accented, raised, wide and joined letters as the ASCII letters they stand for (``º`` o, ``²`` 2, ``ﬁ`` fi)."""
    low = F.lower(text)
    wide = low
    for letter, plain in SEVERAL.items():
        wide = F.replace(wide, F.lit(letter), F.lit(plain))
    # Letters that stand for several are rare; the others go by one translation.
    return F.translate(F.when(low.rlike(f"[{re.escape(''.join(SEVERAL))}]"), wide).otherwise(low), ACCENTED, PLAIN)


def text_key(text: Column) -> Column:
    """Comparison key: lower case, no accents, letters a-z and digits only."""
    return F.regexp_replace(fold_accents(text), "[^a-z0-9]", "")


def clean_name(text: Column, prefix: str = "Entradas", longest: int = 70) -> Column:
    """Drop a ticket prefix, a closing bracket that holds a digit, and quotes; cut to ``longest``."""
    t = F.regexp_replace(F.btrim(text, F.lit('"')), rf"(?i)\A\s*{re.escape(prefix)}\s+", "")
    t = F.regexp_replace(t, r"\s*\([^)0-9]*[0-9][^)]*\)\s*\z", "")
    return F.left(F.btrim(F.replace(t, F.lit('"'), F.lit("")), F.lit(" -")), F.lit(longest))


def mask_emails(text: Column) -> Column:
    return F.regexp_replace(text, EMAIL, EMAIL_MASK)


def numbers_in(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(f"({NUMBER})"), F.lit(1))
    return F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit(".")).try_cast("double"))


def price_low(text: Column, free_word: str = "gratis") -> Column:
    return _price(text, free_word, F.array_min)


def price_high(text: Column, free_word: str = "gratis") -> Column:
    return _price(text, free_word, F.array_max)


def _price(text: Column, free_word: str, pick) -> Column:
    nums = numbers_in(text)
    return F.when(F.size(nums) > 0, pick(nums)).when(F.lower(text).contains(free_word), F.lit(0.0))


def family_name(text: Column) -> Column:
    """An event name without its closing year."""
    return F.regexp_replace(text, r"\s*[0-9]{4}\z", "")
