"""Text scalars: counts, cleaning, line filters and prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word: letters and digits of any script, with one inner apostrophe part.
UNICODE_WORD = r"(?U)[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)?"
ASCII_WORD = r"(?U)\b[0-9A-Za-z']+\b"


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def typography(c: Column) -> Column:
    """Straight quotes, plain dashes and spaces; soft hyphens and zero-width marks go."""
    quotes, dashes, spaces = "\u2018\u2019\u201a\u201b\u201c\u201d\u201e", "\u2010\u2011\u2012\u2013\u2014\u2212", "\u00a0\u2007\u202f"
    plain = F.translate(c, quotes + dashes + spaces, "'" * 4 + '"' * 3 + "-" * len(dashes) + " " * len(spaces))
    return F.regexp_replace(plain, "[\u00ad\u200b-\u200d\ufeff]", "")


#: Fixed value: what counts as white space around a text.
SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a\u2028\u2029\u205f\u3000"


def plain(c: Column) -> Column:
    """Straight single quotes, plain dashes, no fixed spaces; soft hyphens, zero-width marks and outer spaces go."""
    t = F.translate(c, "\u2019\u2018\u00a0\u2010\u2011\u2012\u2013\u2014\u2212", "'' ------")
    return F.btrim(F.regexp_replace(t, "[\u00ad\u200b-\u200d\ufeff]", ""), F.lit(SPACES))


#: The marks of a list, by template, and the bytes of a bullet that were read in another encoding.
BULLETS = {"GNG": "[oO]", "AFS": "[oO•]"}
BROKEN_BULLET = "ï‚·"


def flatten(c: Column, template: str = "GNG") -> Column:
    """A text as its words are counted: on one line, words cut at a line end put together, without bullets, &, - and /."""
    joined = F.regexp_replace(plain(c), r"(?U)(\w)-\s*\n\s*(\w)", "$1$2")
    unmarked = F.regexp_replace(joined, rf"(?mdU)^\s*{BULLETS[template]}\s+", "")
    return squeeze(F.translate(F.replace(unmarked, F.lit(BROKEN_BULLET), F.lit("")), "&-/", ""))


def word_count(c: Column, template: str = "GNG") -> Column:
    return F.regexp_count(flatten(c, template), F.lit(UNICODE_WORD)).cast("long")


def ascii_word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(ASCII_WORD)).cast("long")


#: How operation numbers are written in each template, and the note types of file names.
OPERATION = {"GNG": r"\b(?:\d{8}|\d{4}-\d{4})\b", "AFS": r"(?<![A-Za-z0-9])(?:\d{8}|\d{4}-\d{4})(?![A-Za-z0-9])", "OTHER": r"(?<![A-Za-z0-9])(?:20\d{6}|20\d{2}-\d{4,6})(?![A-Za-z0-9])"}
NOTE_TYPES = r"(?i)(NOTEMCDEC|NOTEMCDISC|NOTEMCINFO)"
#: How many characters of an OTHER note's text are searched for its number.
OTHER_HEAD = 4000


def operation_number(name: Column, text: Column, template: str) -> Column:
    """The number in the name, else in the text, without hyphens; null if there is none."""
    head = F.substring(text, 1, OTHER_HEAD) if template == "OTHER" else text
    found = [F.nullif(F.regexp_extract(c, OPERATION[template], 0), F.lit("")) for c in (name, head)]
    if template == "GNG":
        found.insert(0, F.nullif(F.regexp_extract(name, r"(?i)MCGNG\s+(\d+)", 1), F.lit("")))
    return F.replace(F.coalesce(*found), F.lit("-"), F.lit(""))


def note_type(name: Column) -> Column:
    return F.nullif(F.upper(F.regexp_extract(name, NOTE_TYPES, 1)), F.lit(""))


def is_table_line(c: Column) -> Column:
    """Four tokens or more, over half of them digits once commas, points and percent signs are taken out."""
    tokens = F.filter(F.split(F.trim(c), r"\s+"), lambda x: x != "")
    numbers = F.filter(tokens, lambda x: F.translate(x, ",.%", "").rlike(r"(?U)^\d+$"))
    return (F.size(tokens) >= 4) & (F.size(numbers) * 2 > F.size(tokens))


#: What the footers of the pages of a template look like, and why a line that does is left out.
PAGE_NUMBER, PAGE_OF = r"^\s*-\s*\d+\s*-\s*$", r"(?i)\b\d+\s+of\s+\d+\b"
FOOTERS = {
    "GNG": [(r"(?i)\bMC[_\s-]?GNG\b", "MC_GNG footer"), (r"(?i)^corporate use$", "Corporate Use footer")],
    "AFS": [(r"(?i)\bMC\s+AFS\b", "MC AFS footer"), (r"(?i)\bConfidential\b", "Confidential footer/header"), (r"(?i)corporate use", "Corporate Use footer")],
}


def noise_reason(c: Column, template: str) -> Column:
    """Why a line of a note is no text of it, null if it is: the first reason that holds."""
    t = F.trim(c)
    rules = [(PAGE_NUMBER, "page number"), (PAGE_OF, "x of y page marker"), *FOOTERS[template]]
    return F.coalesce(F.when(t == "", "blank line"), *[F.when(t.rlike(p), F.lit(reason)) for p, reason in rules])


#: Fixed value: how a line that announces a table of contents reads.
CONTENTS_LINE = r"(?i)^contents|table of contents"


def is_contents(lines: Column) -> Column:
    """Whether one of the first ten lines that aren't blank announces a table of contents."""
    filled = F.filter(F.transform(lines, plain), lambda x: x != "")
    return F.exists(F.slice(filled, 1, 10), lambda x: x.rlike(CONTENTS_LINE))


def canonical_prefix(c: Column) -> Column:
    """Upper case, no spaces, runs of - and / one hyphen, and two spellings of one group brought together."""
    t = F.regexp_replace(F.regexp_replace(F.upper(c), r"\s+", ""), "[-/]+", "-")
    return F.when(t.rlike(r"^GR&C-?RM$"), "GR&C-RM").when(t.rlike(r"^GR&C-?OCCO$"), "GR&C-OCCO").otherwise(t)


def export_prefix(c: Column) -> Column:
    """The service column that a canonical prefix counts under."""
    return F.when(c == "GR&C-RM", "RM").when(c.isin("GR&C-OCCO", "OCCO"), "OCCO").otherwise(c)


def label(c: Column, names: dict[str, str]) -> Column:
    """Names for codes; a code without one stands for itself."""
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), c), c) if pairs else c


#: The forms of a division in AFS and GNG notes and of a service code in OTHER notes.
DIVISION = r"^[A-Z]{2}[A-Za-z0-9&.\- ]*(?:/[A-Za-z0-9&().,'\- ]+)+$"
SERVICE_CODE = r"^[A-ZÀ-ÖØ-Þ]{2,}[A-Za-z0-9À-ÖØ-öø-ÿ&/.,()'\- ]{3,}$"


def division_author(c: Column) -> Column:
    """The author of an AFS or GNG note, null unless it is a division with a slash."""
    t = F.trim(typography(c))
    return F.when(t.rlike(DIVISION), t)


def service_author(c: Column) -> Column:
    """The author of an OTHER note: numbers taken out, null unless it is a service code with a slash or a hyphen."""
    t = F.regexp_replace(squeeze(c), r"(?<![A-Za-z0-9])20\d{2}-\d{0,6}(?![A-Za-z0-9])", "")
    t = F.regexp_replace(squeeze(F.regexp_replace(t, "/{2,}", "/")), r"(?<!-)/$", "")
    t = F.trim(t)
    number = t.rlike(r"^\s*(?:\d{8}|\d{4}-\d{4,6})\s*$")
    return F.when(t.rlike("[/-]") & t.rlike(SERVICE_CODE) & ~number & ~F.lower(t).startswith("corporate use"), t)


def thousands(c: Column, digits: int = 0) -> Column:
    """A number for display: thousands apart by commas, `digits` decimals; a missing one is empty."""
    return F.coalesce(F.format_number(c, digits), F.lit(""))


def value_label(c: Column, suffix: str = "") -> Column:
    """A number as charts show it: whole, or with one decimal where a small number would lose it; percentages are whole.

    Halves go away from zero.
    """
    small = (F.abs(c) < 10) & (F.abs(c % 1) > 0.01) & F.lit(suffix != "%")
    shown = lambda digits: F.format_number(F.round(c, digits), digits)
    return F.concat(F.when(small, F.regexp_replace(shown(1), r"\.0$", "")).otherwise(shown(0)), F.lit(suffix))


def short_label(c: Column, most: int = 28) -> Column:
    """A label cut to `most` - 1 characters and three points if it is longer; a missing one is "Missing"."""
    t = F.coalesce(c, F.lit("Missing"))
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most - 1), F.lit("..."))).otherwise(t)


def html_text(c: Column) -> Column:
    """Text in which no character is markup."""
    out = F.coalesce(c, F.lit(""))
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(mark), F.lit(name))
    return out
