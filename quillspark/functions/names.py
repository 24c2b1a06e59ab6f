"""Keys for names that were written differently."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache
def _foldings() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility decomposition has one ASCII character, and those where it has several."""
    found = {}
    for k in range(128, 0x30000):
        if not 0xD800 <= k < 0xE000 and (t := unicodedata.normalize("NFKD", chr(k)).encode("ascii", "ignore").decode()):
            found[chr(k)] = t
    return {c: t for c, t in found.items() if len(t) == 1}, {c: t for c, t in found.items() if len(t) > 1}


def to_ascii(c: Column) -> Column:
    """Compatibility decomposition without what isn't ASCII.

    Nearly every letter has one ASCII letter and is translated; the few characters that have several, as ligatures do, are
    looked up one by one, and only in texts that still hold some character beyond ASCII. The rest goes.
    """
    single, several = _foldings()
    folded = F.translate(c, "".join(single), "".join(single.values()))
    pairs = F.map_from_arrays(F.split(F.lit("\n".join(several)), "\n"), F.split(F.lit("\n".join(several.values())), "\n"))
    one = lambda x: F.when(x.rlike(r"^[\x00-\x7f]$"), x).otherwise(F.coalesce(F.try_element_at(pairs, x), F.lit("")))
    parts = F.transform(F.regexp_extract_all(folded, F.lit("(?s)."), F.lit(0)), one)
    return F.when(folded.rlike(r"^[\x00-\x7f]*\z"), folded).otherwise(F.array_join(parts, ""))


def clean_key(c: Column, ascii_only: bool = False) -> Column:
    """Upper case, no .PDF at the end, no ordinal at the start, letters and digits only. `ascii_only`: c has no other letters."""
    plain = F.upper(c if ascii_only else to_ascii(c))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, r"\.PDF$", ""), r"^\s*\d+\s*[.)_-]+\s*", ""), "[^A-Z0-9]", "")


#: What single-byte readings of UTF-8 punctuation look like, and what was meant.
MOJIBAKE = {"â€™": "’", "â€˜": "‘", "â€œ": "“", "â€“": "–", "â€”": "—", "â€¦": "…", "Â ": " "}


def _repair(text: str) -> str:
    for _ in range(2):
        if not any(c in text for c in "ÃÂâ"):
            break
        try:
            text = text.encode("cp1252").decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            break
    # What a mixed text still has of single marks.
    for wrong, right in MOJIBAKE.items():
        text = text.replace(wrong, right)
    return unicodedata.normalize("NFC", text)


def _repaired(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else _repair(x))


def repair_mojibake(c: Column) -> Column:
    """Undoes UTF-8 text that was read as Windows-1252, at most twice."""
    return F.pandas_udf(_repaired, "string")(c)


def fold_key(c: Column) -> Column:
    return F.lower(F.trim(repair_mojibake(c)))
