"""From page texts to note rows.

Pages are cut to lines with one order over the whole document, and every rule of a template is a flag on lines: a
section starts at the first flagged line, stops before the first stop line, and is cut into segments by a running count
of headings. So GNG and AFS notes need windows by document only. In OTHER notes an accepted opinion moves the scan on to
its end and a rejected header to its own, which no flag on one line can tell; each document's text is scanned whole.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from quillspark.functions.text import CONTENTS_LINE, canonical_prefix, division_author, export_prefix, is_table_line, noise_reason, plain, service_author, word_count
from quillspark.schema import SERVICES

#: Patterns of the GNG template. A line is compared after its dashes, quotes and spaces are made plain.
GNG_SECTION = r"(?i)^\s*6\.\s+Services'?\s+acknowledgement"
GNG_STOP_WORDS = r"\bExpected\s+timetable\b"
GNG_ANNEX_WORDS = r"\bGNG\s+validation\b"
GNG_STOP, GNG_ANNEX = "(?i)" + GNG_STOP_WORDS, "(?i)" + GNG_ANNEX_WORDS
GNG_HEADING = r"(?i)^\s*(GR\s*&\s*C\s*[-/]?\s*OCCO|GR\s*&\s*C\s*[-/]?\s*RM|OCCO|ECON|PJ|JU)\s*(?:contribution)?\s*$"
#: Patterns of the AFS template and the prefixes that open an opinion, with the service they count under.
AFS_OPINIONS = r"(?i)^\s*(\d+\s*[).]?\s*)?(?:Services\s+)?Opinions?\s*$"
AFS_TIMETABLE = r"(?i)^\s*(\d+\s*[).]?\s*)?Timetable\b"
AFS_ANNEX = r"(?i)\bFact\s+Sheet\s+validation\b"
AFS_COMMITTEE = r"(?i)^\s*F\.\s*Project\s+Committee\b"
AFS_OUTCOME = r"(?i)^\s*Outcome\s+of\s+OCCO\s+assessment\b"
AFS_GROUPS = {
    "GR&C-RM": "RM", "GR&C-RM/CCRD": "RM", "RM/OPE": "RM", "GR&C/CCRD": "RM", "OCCO": "OCCO", "GR&C-OCCO": "OCCO", "FI": "FI", "GLO": "GLO",
    "OPS": "OPS", "OPS DIR": "OPS", "OPS/GLO": "OPS", "OPS AND GLO": "OPS", "PJ": "PJ", "PJ DIR": "PJ", "IG": "IG", "IG/EV": "IG", "SG ECON": "ECON", "ECON": "ECON",
    "JU": "JU", "CFC": "CFC", "EIF": "EIF", "PMM": "PMM", "SG": "SG", "GIS": "GIS", "HR": "HR",
}
#: Prefixes of the OTHER template and the service they count under.
OTHER_GROUPS = {
    "OPS": "OPS", "OPS DIR": "OPS", "OPS/GLO": "OPS", "GLO": "GLO", "PJ": "PJ", "PJ DIR": "PJ", "RM": "RM", "GR&C-RM": "RM", "GR_C-RM": "RM", "GR&C RM": "RM", "GRC-RM": "RM", "GR C RM": "RM",
    "OCCO": "OCCO", "GR&C-OCCO": "OCCO", "GR_C-OCCO": "OCCO", "JU": "JU", "ECON": "ECON", "SG ECON": "ECON", "CFC": "CFC", "FC": "CFC", "EIF": "EIF", "FI": "FI", "IG": "IG", "IG/EV": "IG",
    "PMM": "PMM", "SG": "SG", "GIS": "GIS", "IS": "GIS", "HR": "HR", "OTHER": "OTHER",
}


def page_lines(pages: DataFrame) -> DataFrame:
    """doc_id, page_no, ord, line, t: lines of (doc_id, page_no, page_text) in one order over the document."""
    lines = pages.select("doc_id", "page_no", F.posexplode(F.split(F.coalesce("page_text", F.lit("")), "\n")).alias("at", "line"))
    order = W.partitionBy("doc_id").orderBy("page_no", "at")
    return lines.withColumn("t", plain(F.col("line"))).withColumn("ord", F.row_number().over(order)).drop("at")


def joined(lines: DataFrame, template: str, *keys: str) -> DataFrame:
    """By key the lines in order as one text, and its words."""
    parts = F.array_sort(F.collect_list(F.struct("ord", "t")))
    return lines.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["t"]), "\n").alias("text")).withColumn("words", word_count(F.col("text"), template))


def _noise(template: str) -> Column:
    return noise_reason(F.col("t"), template).isNotNull()


def _first(flag: Column) -> Column:
    return F.min(F.when(flag, F.col("ord")))


def _wide(segments: DataFrame) -> DataFrame:
    """Words by service as columns; no words are null."""
    out = segments.groupBy("doc_id").pivot("service", SERVICES).agg(F.sum("words"))
    return out.select("doc_id", *[F.nullif(F.col(s), F.lit(0)).alias(s) for s in SERVICES])


def gng_segments(lines: DataFrame) -> DataFrame:
    """doc_id, segment, prefix, service, words of the contributions in section 6 of each note, headings included."""
    t = F.col("t")
    doc = W.partitionBy("doc_id")
    start = F.min(F.when(t.rlike(GNG_SECTION), F.col("ord"))).over(doc)
    inside = lines.withColumn("start", start).filter(F.col("ord") >= F.col("start"))
    stop = F.min(F.when(t.rlike(GNG_STOP), F.col("ord"))).over(doc)
    inside = inside.withColumn("stop", stop).filter(F.col("stop").isNull() | (F.col("ord") <= F.col("stop")))
    # Of the stop line, what stands before the words that stop.
    inside = inside.withColumn("t", F.when(F.col("ord") == F.col("stop"), F.regexp_replace(t, "(?is)" + GNG_STOP_WORDS + ".*$", "")).otherwise(t))
    kept = inside.filter(~_noise("GNG"))
    prefix = F.when(t.rlike(GNG_HEADING), canonical_prefix(F.regexp_extract("t", GNG_HEADING, 1)))
    ordered = doc.orderBy("ord")
    before = F.last("prefix", ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, -1))
    marked = kept.withColumn("prefix", prefix).withColumn("new", F.col("prefix").isNotNull() & ~F.col("prefix").eqNullSafe(before))
    cut = marked.withColumn("segment", F.sum(F.col("new").cast("long")).over(ordered)).filter("segment > 0")
    named = cut.withColumn("head", F.first(F.when(F.col("new"), F.col("prefix")), ignorenulls=True).over(W.partitionBy("doc_id", "segment")))
    words = joined(named.filter(~((F.col("segment") == 1) & is_table_line(t))), "GNG", "doc_id", "segment", "head")
    return words.select("doc_id", "segment", F.col("head").alias("prefix"), export_prefix(F.col("head")).alias("service"), "words")


def extract_gng(pages: DataFrame) -> DataFrame:
    """One row for each note: page counts, words before opinions and words by service. Null stands where a rule found nothing."""
    lines = page_lines(pages)
    t = F.col("t")
    facts = lines.groupBy("doc_id").agg(
        F.max("page_no").alias("pages"), _first(t.rlike(GNG_SECTION)).alias("start"), F.min(F.when(t.rlike(GNG_SECTION), F.col("page_no"))).alias("pages_before"), _first(t.rlike(GNG_STOP)).alias("timetable"),
    )
    after = (F.col("ord") > F.col("timetable")) | ((F.col("ord") == F.col("timetable")) & t.rlike("(?i)" + GNG_STOP_WORDS + ".*" + GNG_ANNEX_WORDS))
    annex = lines.join(facts.select("doc_id", "timetable"), "doc_id").filter(after & t.rlike(GNG_ANNEX)).groupBy("doc_id").agg(F.min("page_no").alias("annex_from"))
    noise = _noise("GNG")
    before = joined(lines.join(facts.select("doc_id", "start"), "doc_id").filter((F.col("ord") < F.col("start")) & ~noise), "GNG", "doc_id").select("doc_id", F.col("words").alias("before"))
    out = facts.join(annex, "doc_id", "left").join(before, "doc_id", "left").join(_wide(gng_segments(lines)), "doc_id", "left")
    words = F.when(F.col("start").isNotNull(), F.coalesce("before", F.lit(0)))
    return out.select("doc_id", F.lit("GNG").alias("template"), "pages", "pages_before", (F.col("pages") - F.col("annex_from")).alias("annex_pages"), words.alias("words"), *SERVICES)


def gng_provenance(pages: DataFrame) -> DataFrame:
    """By document how its rows came about: what opened and closed section 6 and where, which lines were left out and why,
    and which lines look like headings of contributions and whether they count."""
    lines = page_lines(pages)
    t, doc = F.col("t"), W.partitionBy("doc_id")
    start = F.min(F.when(t.rlike(GNG_SECTION), F.col("ord"))).over(doc)
    marked = lines.withColumn("start", start).withColumn("after", F.coalesce(F.col("ord") >= F.col("start"), F.lit(False)))
    marked = marked.withColumn("stop", F.min(F.when(F.col("after") & t.rlike(GNG_STOP), F.col("ord"))).over(doc))
    inside = F.col("after") & (F.col("stop").isNull() | (F.col("ord") <= F.col("stop")))
    prefix = canonical_prefix(F.regexp_extract("t", GNG_HEADING, 1))
    marked = marked.withColumns({"reason": F.when(inside, noise_reason(t, "GNG")), "prefix": F.when(inside & t.rlike(GNG_HEADING), prefix)})
    before = F.last("prefix", ignorenulls=True).over(doc.orderBy("ord").rowsBetween(W.unboundedPreceding, -1))
    marked = marked.withColumn("accepted", F.col("prefix").isNotNull() & ~F.col("prefix").eqNullSafe(before))
    listed = lambda flag, *columns: F.array_sort(F.collect_list(F.when(flag, F.struct("ord", *columns))))
    return marked.groupBy("doc_id").agg(
        F.max("start").isNotNull().alias("section_found"), F.max(F.when(F.col("ord") == F.col("start"), F.regexp_extract("t", GNG_SECTION, 0))).alias("section_text"),
        F.max(F.when(F.col("ord") == F.col("start"), F.col("page_no"))).alias("section_page"), F.max(F.when(F.col("ord") == F.col("stop"), F.regexp_extract("t", GNG_STOP, 0))).alias("stop_text"),
        F.max("stop").alias("stop_line"), listed(F.col("reason").isNotNull(), "line", "reason").alias("removed"), listed(F.col("prefix").isNotNull(), "line", "prefix", "accepted").alias("headings"),
    )


def output_rows(rows: DataFrame, section: str | None = None, missing: str = "N/A") -> DataFrame:
    """The rows as files show them: a service without words is blank, and all are `missing` where the note has no `section`."""
    shown = {s: F.coalesce(F.nullif(F.col(s), F.lit(0)).cast("string"), F.lit("")) for s in SERVICES}
    if section:
        shown = {s: F.when(F.col(section), c).otherwise(F.lit(missing)) for s, c in shown.items()}
    return rows.withColumns(shown)


def _afs_prefixes() -> str:
    return "|".join(re.escape(p).replace("\\ ", r"\s+") for p in sorted(AFS_GROUPS, key=lambda p: (-len(p), p)))


def afs_lines(pages: DataFrame) -> DataFrame:
    """Lines of AFS notes with what each is: prefix (opening an opinion), is_header, is_stop, is_timetable, on_contents."""
    lines = page_lines(pages)
    t = F.col("t")
    filled = F.when(t != "", F.lit(1))
    nth = F.sum(filled).over(W.partitionBy("doc_id", "page_no").orderBy("ord"))
    lines = lines.withColumn("nth", nth)
    contents = F.max((t != "") & (F.col("nth") <= 10) & t.rlike(CONTENTS_LINE)).over(W.partitionBy("doc_id", "page_no"))
    names = _afs_prefixes()
    block, alone = rf"(?i)^\s*(?:[A-Z]\.\s+|\d+\.\s+)?({names})\s+(Opinion|position|input)\b", rf"(?i)^({names})$"
    prefix = F.when(t.rlike(block), F.regexp_extract("t", block, 1)).when(t.rlike(AFS_OUTCOME), "OCCO").when(t.rlike(alone), t)
    last = F.last(F.when(t != "", t), ignorenulls=True).over(W.partitionBy("doc_id").orderBy("ord").rowsBetween(W.unboundedPreceding, -1))
    committee = t.rlike(AFS_COMMITTEE) | (last.rlike(r"^\s*F\.\s*$") & t.rlike(r"(?i)\bProject\s+Committee\b"))
    return lines.withColumns({
        "on_contents": F.coalesce(contents, F.lit(False)), "prefix": F.upper(F.regexp_replace(prefix, r"\s+", " ")), "is_header": t.rlike(AFS_OPINIONS),
        "is_timetable": t.rlike(AFS_TIMETABLE), "is_committee": F.coalesce(committee, F.lit(False)),
    }).drop("nth")


def afs_start(lines: DataFrame) -> DataFrame:
    """doc_id, mode, start (line), opens (first line of opinions), start_page.

    Opinions start at the first opening line after the opinions header that no stop precedes; without one at the header;
    without a header at the first opening line of the note.
    """
    live = lines.filter(~F.col("on_contents"))
    stop = F.col("is_timetable") | F.col("is_committee")
    top = live.groupBy("doc_id").agg(_first(F.col("is_header")).alias("header"), _first(F.col("prefix").isNotNull()).alias("open0"), _first(stop).alias("stop0"))
    rest = live.join(top, "doc_id").filter(F.col("ord") > F.col("header"))
    later = rest.groupBy("doc_id").agg(_first(F.col("prefix").isNotNull()).alias("open1"), _first(stop).alias("stop1"))
    far = F.lit(2**31)
    first = F.when(F.col("open0") < F.coalesce("stop0", far), F.col("open0"))
    after = F.when(F.col("open1") < F.coalesce("stop1", far), F.col("open1"))
    both = top.join(later, "doc_id", "left").withColumns({"first": first, "after": after})
    early = F.coalesce(F.col("first") < F.col("header"), F.lit(False))
    mode = (
        F.when(F.col("after").isNotNull() & early, "fallback_then_primary_to_first_counted").when(F.col("after").isNotNull(), "primary_to_first_counted")
        .when(F.col("header").isNotNull(), "primary_no_counted_prefix").when(F.col("first").isNotNull(), "fallback_counted_prefix")
    )
    start = F.coalesce("after", "header", "first")
    opens = F.coalesce(F.col("after"), F.col("header") + 1, F.col("first"))
    found = both.select("doc_id", mode.alias("mode"), start.alias("start"), opens.alias("opens"))
    page = lines.join(found.select("doc_id", "start"), "doc_id").filter(F.col("ord") == F.col("start")).select("doc_id", F.col("page_no").alias("start_page"))
    return found.join(page, "doc_id", "left")


def afs_segments(lines: DataFrame, starts: DataFrame) -> DataFrame:
    t = F.col("t")
    own = lines.join(starts, "doc_id").filter((F.col("ord") >= F.col("opens")) & (~F.col("on_contents") | (F.col("page_no") == F.col("start_page"))))
    doc = W.partitionBy("doc_id")
    opened = F.min(F.when(F.col("prefix").isNotNull(), F.col("ord"))).over(doc)
    # The committee stops opinions only once one has begun.
    own = own.withColumn("opened", opened)
    stop = F.min(F.when(F.col("is_timetable") | (F.col("is_committee") & (F.col("ord") >= F.col("opened"))), F.col("ord"))).over(doc)
    own = own.withColumn("stop", stop).filter(F.col("stop").isNull() | (F.col("ord") < F.col("stop")))
    own = own.filter(~_noise("AFS"))
    cut = own.withColumn("segment", F.sum(F.col("prefix").isNotNull().cast("long")).over(doc.orderBy("ord"))).filter("segment > 0")
    named = cut.withColumn("head", F.first("prefix", ignorenulls=True).over(W.partitionBy("doc_id", "segment")))
    words = joined(named.filter("prefix is null"), "AFS", "doc_id", "segment", "head")
    pairs = [F.lit(x) for kv in AFS_GROUPS.items() for x in kv]
    return words.select("doc_id", "segment", F.col("head").alias("prefix"), F.element_at(F.create_map(*pairs), F.col("head")).alias("service"), "words")


def extract_afs(pages: DataFrame) -> DataFrame:
    lines = afs_lines(pages)
    starts = afs_start(lines)
    t = F.col("t")
    facts = lines.groupBy("doc_id").agg(F.max("page_no").alias("pages"), _first(F.col("is_timetable")).alias("timetable"))
    annex = lines.join(facts.select("doc_id", "timetable"), "doc_id").filter(t.rlike(AFS_ANNEX) & (F.col("ord") >= F.coalesce("timetable", F.lit(0)))).groupBy("doc_id").agg(F.min("page_no").alias("annex_from"))
    noise = _noise("AFS")
    early = lines.join(starts, "doc_id", "left").filter(~F.col("on_contents") & ~noise & (F.col("start").isNull() | (F.col("ord") < F.col("start"))))
    before = joined(early, "AFS", "doc_id").select("doc_id", F.col("words").alias("before"))
    out = facts.join(starts, "doc_id", "left").join(annex, "doc_id", "left").join(before, "doc_id", "left").join(_wide(afs_segments(lines, starts)), "doc_id", "left")
    return out.select("doc_id", F.lit("AFS").alias("template"), "pages", F.col("start_page").alias("pages_before"), (F.col("pages") - F.col("annex_from")).alias("annex_pages"), F.coalesce("before", F.lit(0)).alias("words"), "mode", *SERVICES)


def afs_provenance(pages: DataFrame) -> DataFrame:
    """By document how its rows came about: how its opinions were found and where, what closed them, which lines of theirs
    were left out and why, and which lines open an opinion and whether they count.

    An opening line counts if it stands among the opinions; those before them, behind their end and on contents pages don't.
    """
    lines = afs_lines(pages)
    starts = afs_start(lines)
    t, doc = F.col("t"), W.partitionBy("doc_id")
    own = lines.join(starts, "doc_id", "left").withColumn("live", (F.col("ord") >= F.col("opens")) & (~F.col("on_contents") | (F.col("page_no") == F.col("start_page"))))
    opened = F.min(F.when(F.col("live") & F.col("prefix").isNotNull(), F.col("ord"))).over(doc)
    own = own.withColumn("opened", opened)
    closing = F.col("live") & (F.col("is_timetable") | (F.col("is_committee") & (F.col("ord") >= F.col("opened"))))
    own = own.withColumn("stop", F.min(F.when(closing, F.col("ord"))).over(doc))
    inside = F.coalesce(F.col("live") & (F.col("stop").isNull() | (F.col("ord") < F.col("stop"))), F.lit(False))
    own = own.withColumns({"inside": inside, "reason": F.when(inside, noise_reason(t, "AFS"))})
    listed = lambda flag, *columns: F.array_sort(F.collect_list(F.when(flag, F.struct("ord", *columns))))
    return own.groupBy("doc_id").agg(
        F.max("mode").alias("mode"), F.max(F.when(F.col("ord") == F.col("start"), F.col("line"))).alias("start_text"), F.max("start_page").alias("start_page"), F.max("start").alias("start_line"),
        F.max(F.when(F.col("ord") == F.col("stop"), F.col("line"))).alias("stop_text"), F.max("stop").alias("stop_line"), listed(F.col("reason").isNotNull(), "line", "reason").alias("removed"),
        listed(F.col("prefix").isNotNull(), "line", "prefix", F.col("inside").alias("accepted")).alias("headings"),
    )


def annex_provenance(pages: DataFrame, template: str) -> DataFrame:
    """By document the line at which its annexes begin: doc_id, annex_text, annex_page, annex_line, after (the timetable's line)."""
    lines = page_lines(pages)
    t = F.col("t")
    timetable, annex = (AFS_TIMETABLE, AFS_ANNEX) if template == "AFS" else (GNG_STOP, GNG_ANNEX)
    marked = lines.withColumn("after", F.min(F.when(t.rlike(timetable), F.col("ord"))).over(W.partitionBy("doc_id")))
    behind = F.col("ord") >= (F.coalesce("after", F.lit(0)) if template == "AFS" else F.col("after"))
    hit = marked.filter(t.rlike(annex) & behind).groupBy("doc_id").agg(F.min_by(F.struct("line", "page_no", "ord"), "ord").alias("at"), F.max("after").alias("after"))
    return hit.select("doc_id", F.col("at.line").alias("annex_text"), F.col("at.page_no").alias("annex_page"), F.col("at.ord").alias("annex_line"), "after")


#: Patterns of the OTHER template.
_SECTION = re.compile(r"6\s+OPINIONS\s+FROM\s+THE\s+SERVICES|OPINIONS\s+FROM\s+THE\s+SERVICES", re.IGNORECASE)
_HEADER = re.compile(r"\b\d+\.\d+\b.{0,80}\bOpinion\b", re.IGNORECASE)
_END = re.compile(r"\b[Vv]alidated\s+by\s+[A-ZÀ-ÖØ-Þ][A-ZÀ-ÖØ-Þ'’\-.]{1,}(?:\s+[A-ZÀ-ÖØ-Þ][A-Za-zÀ-ÖØ-öø-ÿ'’\-.]+)?")
_STRICT = re.compile(r"\bValidated\s+by\s+.{2,220}?\bAt\s+\d{2}(?:/|\.)\d{2}(?:/|\.)\d{4}\s+\d{1,2}:\d{2}\b", re.IGNORECASE | re.DOTALL)
_LOOSE = re.compile(r"\b[Vv]alidated\s+by\s+[A-ZÀ-ÖØ-Þ]{2,}\b")
_ASCII_WORD = re.compile(r"\b[0-9A-Za-z']+\b")


def _key(s: str) -> str:
    return re.sub("[^A-Z0-9]", "", s.upper())


def _spans(pattern: re.Pattern, text: str, first: int) -> list[tuple[int, int]]:
    """(start, end) of the match at each place from `first` on where the pattern has one, in order; they may overlap."""
    return [(m.start(), m.end(1)) for m in re.compile(f"(?=({pattern.pattern}))", pattern.flags).finditer(text, first)]


@dataclass
class Opinions:
    """What the section of opinions of one note holds: words by service, and where its last opinion ends."""

    section: bool = False
    words: dict[str, int] = field(default_factory=dict)
    last_end: int | None = None
    #: (start, header, service, what closes it, words, whether it counts) of every header that is looked at.
    seen: list[tuple[int, str, str | None, str | None, int | None, bool]] = field(default_factory=list)
    title: str | None = None


def _owner(header: str, keyed: list[tuple[str, str]], near: int) -> str | None:
    """The service of the longest prefix that a header names, if the name begins within its first `near` characters."""
    key = _key(header)
    named = [(key.index(k), service) for k, service in keyed if k in key]
    return named[0][1] if named and named[0][0] <= near else None


def opinions_of(text: str, groups: dict[str, str], near: int = 18) -> Opinions:
    """Opinions after the section's title: from a numbered header with a known prefix to the next validation.

    Headers and validations are spans, found once and in order. A header opens an opinion unless it begins inside the
    header or the opinion before it; one word alone is no opinion; a header without a validation after it ends the section.
    """
    title = _SECTION.search(text)
    if not title:
        return Opinions()
    keyed = sorted(((_key(p), service) for p, service in groups.items() if _key(p)), key=lambda x: -len(x[0]))
    closings = _spans(_END, text, title.end())
    out, free = Opinions(section=True, title=title[0]), title.end()
    for start, end in _spans(_HEADER, text, title.end()):
        if start < free:
            continue
        service, free = _owner(text[start:end], keyed, near), end
        if service is None:
            out.seen.append((start, text[start:end], None, None, None, False))
            continue
        after = bisect.bisect_left(closings, (end, end))
        if after == len(closings):
            out.seen.append((start, text[start:end], service, None, None, False))
            break
        close, free = closings[after]
        words = _ascii_words(text[end:close])
        out.seen.append((start, text[start:end], service, text[close:free], words, words > 1))
        if words > 1:
            out.words[service] = out.words.get(service, 0) + words
            out.last_end = free
    return out


def _ascii_words(text: str) -> int:
    return len(_ASCII_WORD.findall(re.sub(r"\s+", " ", text.replace("\u200b", "")).strip()))


def _page_at(pages: list[str], position: int) -> int:
    end = 0
    for k, p in enumerate(pages, 1):
        end += len(p) + 1
        if position < end:
            return k
    return len(pages)


def read_other(pages: list[str], groups: dict[str, str]) -> dict:
    """The measures of one OTHER note: counts on the text with its spaces squeezed, annexes on the text as it stands."""
    pages = [p or "" for p in pages]
    raw, total = "\n".join(pages), len(pages)
    opinions = opinions_of(re.sub(r"\s+", " ", raw.replace("​", "")).strip(), groups)
    top_down = next((total - k for k, p in enumerate(pages, 1) if _STRICT.search(p) or _LOOSE.search(p)), None)
    title = next(((k, m) for k, p in enumerate(pages, 1) if (m := _SECTION.search(p))), None)
    if title:
        k, m = title
        before, words = k, _ascii_words("\n".join([*pages[: k - 1], pages[k - 1][: m.start()]]))
        last = opinions_of(raw, groups).last_end
        if last is not None:
            annex = total - _page_at(pages, last)
        else:
            annex = next((total - k for k in range(total, 0, -1) if _END.search(pages[k - 1])), None)
    else:
        before = max(0, total - (top_down or 0))
        words, annex = _ascii_words("\n".join(pages[:before])), top_down
    return {"pages": total, "pages_before": before, "annex_pages": annex, "words": words, "section": opinions.section, "services": opinions.words}


def extract_other(pages: DataFrame, groups: dict[str, str] | None = None) -> DataFrame:
    """One row for each note; services are null where the section is missing or has none of them."""
    groups = groups or OTHER_GROUPS
    body = F.transform(F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("page_text", F.lit("")).alias("p")))), lambda x: x["p"])
    whole = pages.groupBy("doc_id").agg(body.alias("pages"))

    def run(frames):
        for pdf in frames:
            rows = []
            for doc, texts in zip(pdf.doc_id, pdf["pages"], strict=True):
                r = read_other(list(texts), groups)
                rows.append([doc, "OTHER", r["pages"], r["pages_before"], r["annex_pages"], r["words"], r["section"], *[r["services"].get(s) for s in SERVICES]])
            out = pd.DataFrame(rows, columns=["doc_id", "template", "pages", "pages_before", "annex_pages", "words", "has_section", *SERVICES])
            yield out.astype({c: "Int64" for c in ["annex_pages", *SERVICES]})

    schema = "doc_id long, template string, pages long, pages_before long, annex_pages long, words long, has_section boolean, " + ", ".join(f"{s} long" for s in SERVICES)
    return whole.mapInPandas(run, schema)


def other_provenance(pages: DataFrame, groups: dict[str, str] | None = None) -> DataFrame:
    """By document what its scan for opinions looked at: doc_id, title (null without the section), headers in order, each
    with its service, the validation that closes it, its words, and whether it counts."""
    groups = groups or OTHER_GROUPS
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("page_text", F.lit("")).alias("p")))), lambda x: x["p"]), "\n")
    whole = pages.groupBy("doc_id").agg(body.alias("text"))

    def run(frames):
        for pdf in frames:
            rows = []
            for doc, text in zip(pdf.doc_id, pdf["text"], strict=True):
                found = opinions_of(re.sub(r"\s+", " ", text.replace("\u200b", "")).strip(), groups)
                rows.append([doc, found.title, [dict(zip(("start", "header", "service", "closing", "words", "accepted"), x, strict=True)) for x in found.seen]])
            yield pd.DataFrame(rows, columns=["doc_id", "title", "headers"])

    return whole.mapInPandas(run, "doc_id long, title string, headers array<struct<start:long,header:string,service:string,closing:string,words:long,accepted:boolean>>")


@udtf(returnType="doc_id long, pages long, pages_before long, annex_pages long, words long, has_section boolean, services map<string, long>")
class OtherNote:
    """The measures of OTHER notes as a table function: `TABLE(pages) PARTITION BY doc_id ORDER BY page_no`.

    Spark deals and sorts the pages of (doc_id, page_no, page_text); they come one after another, and no row or group holds
    the pages of a note but this one, which the note's scan looks over as a whole.
    """

    def __init__(self) -> None:
        self.doc, self.pages = None, []

    def eval(self, page: Row) -> None:
        self.doc = page["doc_id"]
        self.pages.append(page["page_text"] or "")

    def terminate(self) -> Iterator[tuple]:
        if self.pages:
            r = read_other(self.pages, OTHER_GROUPS)
            yield self.doc, r["pages"], r["pages_before"], r["annex_pages"], r["words"], r["section"], r["services"]


#: Fixed value: the date of a letterhead.
LETTER_DATE = r"(?i)Luxembourg\b\s*,?\s*(\d{2}[/.]\d{2}[/.]\d{4})"


def header_dates(blocks: DataFrame, pages: list[int] | None = None, left: float = 0.40, top: float = 0.55) -> DataFrame:
    """doc_id, date (DD/MM/YYYY), stage; see header_date_provenance."""
    return header_date_provenance(blocks, pages, left, top).select("doc_id", "date", "stage")


def header_date_provenance(blocks: DataFrame, pages: list[int] | None = None, left: float = 0.40, top: float = 0.55) -> DataFrame:
    """doc_id, date (DD/MM/YYYY), stage, trigger (the date's line), page_no, x0, y0, candidates (lines with a date): a note's
    date from its blocks (doc_id, page_no, page_w, page_h, x0, y0, x1, y1, text, ord).

    First the letter date in a marker's line or the four after it, in the right upper area; then the topmost, rightmost
    letter date there; then the first one anywhere on the page. Pages are tried in order, the first page before others.
    """
    rows = blocks.filter(F.col("page_no").isin(pages)) if pages else blocks
    lines = rows.select("*", F.posexplode(F.split("text", "\n")).alias("at", "line")).withColumn("line", plain(F.col("line"))).filter("line <> ''")
    inside = (F.col("x0") >= left * F.col("page_w")) & (F.col("y0") <= top * F.col("page_h"))
    date = F.nullif(F.regexp_extract("line", LETTER_DATE, 1), F.lit(""))
    marked = lines.withColumns({"inside": inside, "date": date, "marker": F.upper("line").contains("CORPORATE USE")})
    near = F.max(F.when(F.col("marker"), F.lit(1))).over(W.partitionBy("doc_id", "page_no", "inside").orderBy("ord", "at").rowsBetween(-4, 0))
    stage = F.when(F.col("inside") & (near == 1), 1).when(F.col("inside"), 2).otherwise(3)
    ranked = marked.withColumn("stage", stage).filter("date is not null")
    place = F.struct("stage", "page_no", F.when(F.col("stage") == 2, F.col("y0")).alias("y"), F.when(F.col("stage") == 2, -F.col("x1")).alias("x"), "ord", "at")
    best = ranked.groupBy("doc_id").agg(F.min_by(F.struct("date", "stage", F.col("line").alias("trigger"), "page_no", "x0", "y0"), place).alias("b"), F.count("*").alias("candidates"))
    return best.select("doc_id", F.regexp_replace("b.date", r"\.", "/").alias("date"), F.col("b.stage").alias("stage"), "b.trigger", "b.page_no", "b.x0", "b.y0", "candidates")


def author_after_date(lines: DataFrame, within: int = 10) -> DataFrame:
    """doc_id, author: the first division in the lines after the first page's first date, ten lines on at most."""
    first = lines.filter((F.col("page_no") == 1) & (F.col("t") != "")).withColumn("k", F.row_number().over(W.partitionBy("doc_id").orderBy("ord")))
    date = F.min(F.when(F.col("t").rlike(r"\b\d{2}[/.]\d{2}[/.]\d{4}\b"), F.col("k"))).over(W.partitionBy("doc_id"))
    near = first.withColumn("date_at", date).filter((F.col("k") > F.col("date_at")) & (F.col("k") <= F.col("date_at") + within))
    found = near.withColumn("author", division_author(F.col("t"))).filter("author is not null")
    return found.groupBy("doc_id").agg(F.min_by("author", "k").alias("author"))


def corner_date_author(lines: DataFrame) -> DataFrame:
    """doc_id, date (DD/MM/YYYY), author of OTHER notes from the lines (doc_id, ord, text) at the top right of page one.

    A date with slashes counts before one in ISO form; the author is the first service code after the date's line.
    """
    slash, iso = F.regexp_extract("text", r"\b(\d{2}/\d{2}/\d{4})\b", 1), F.regexp_extract("text", r"\b(20\d{2}-\d{2}-\d{2})\b", 1)
    doc = W.partitionBy("doc_id")
    at = F.coalesce(F.min(F.when(slash != "", F.col("ord"))).over(doc), F.min(F.when(iso != "", F.col("ord"))).over(doc))
    day = F.when(slash != "", slash).otherwise(F.date_format(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")), "dd/MM/yyyy"))
    marked = lines.withColumns({"at": at, "day": day, "code": service_author(F.col("text"))})
    after = F.col("code").isNotNull() & (F.col("at").isNull() | (F.col("ord") > F.col("at")))
    return marked.groupBy("doc_id").agg(F.max(F.when(F.col("ord") == F.col("at"), F.col("day"))).alias("date"), F.min_by("code", F.when(after, F.col("ord"))).alias("author"))
