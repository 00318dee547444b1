"""Text normalisation, hashes, dates and citations as column expressions.

Patterns carry ``(?U)`` where classes are meant over Unicode and ``(?d)`` where the dot
stops at line feeds only.  Null texts count as empty and give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

C = Column | str


def _c(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filled(c: C) -> Column:
    """The text, or the empty text for null."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def collapsed(c: C) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(filled(c), r"(?U)\s+", " "))


def collapsed_ascii(c: C) -> Column:
    """As ``collapsed``, for ASCII white space only."""
    return F.trim(F.regexp_replace(filled(c), "[ \\t\\n\\x0B\\f\\r]+", " "))


def any_of(c: C, *words: str) -> Column:
    """Whether the lower-cased text holds one of the words, anywhere."""
    low = F.lower(filled(c))
    out = F.lit(False)
    for word in words:
        out = out | low.contains(word)
    return out


def first_match(cases: list[tuple[Column, object]], otherwise: object) -> Column:
    """The value of the first condition that holds."""
    out = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    end = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return end if out is None else out.otherwise(end)


def token_count(c: C) -> Column:
    """Number of words between white space."""
    return F.size(words(c)).cast("int")


def words(c: C) -> Column:
    """The words between ASCII white space."""
    return F.filter(F.split(filled(c), "[ \\t\\n\\x0B\\f\\r]+"), lambda x: x != "")


# --- Unicode -------------------------------------------------------------------------

# Mojibake and what it stands for, in this order.
_MOJIBAKE = (("Ã¦", "æ"), ("Ã¸", "ø"), ("Ã¥", "å"), ("Ã†", "Æ"), ("Ã˜", "Ø"), ("Ã…", "Å"), ("Ã©", "é"), ("Ã¨", "è"), ("Ã¡", "á"), ("Ã\xad", "í"), ("Ã³", "ó"), ("Ãº", "ú"), ("Ã¼", "ü"), ("Ã¤", "ä"), ("Ã¶", "ö"))


@F.pandas_udf(T.StringType())
def nfkc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unicode compatibility composition; Spark has no function for it."""
    for batch in texts:
        yield batch.str.normalize("NFKC")


def mojibake_fixed(c: C) -> Column:
    """UTF-8 letters that were read as Latin-1, put right."""
    out = filled(c)
    for wrong, right in _MOJIBAKE:
        out = F.replace(out, F.lit(wrong), F.lit(right))
    return out


def unicode_normalized(c: C, compose: bool = True) -> Column:
    """NFKC, special spaces as spaces, collapsed, then mojibake put right.

    Pure ASCII texts skip the only step that leaves the JVM.
    """
    text = filled(c)
    if compose:
        text = F.when(text.rlike(r"^\p{ASCII}*$"), text).otherwise(nfkc(text))
    spaced = F.regexp_replace(text, "[\\u00A0\\u2000-\\u200F\\u2028-\\u202F\\u205F\\u3000]", " ")
    return mojibake_fixed(collapsed(spaced))


# --- cleaning ------------------------------------------------------------------------

# What a legal text is cleaned of, in this order; each match goes.
_LEGAL = (
    r"(?dU)🔗\s*Del paragraf",
    r"(?dU)🔗\s*.*",
    r"(?dU)Se også.*",
    r"(?dU)Gå til.*",
    r"\[Til toppen\]",
    r"\[Tilbake\]",
    r"\[Neste\]",
    r"\[Forrige\]",
    r"(?dUiu)Rettskilder.*",
    r"(?dUiu)Business and organisation.*",
    r"(?dUiu)Hovedmeny.*",
    r"(?dUiu)Navigasjon.*",
    r"(?dU)Endret ved.*?🔗Del paragraf",
    r"(?dU)Endret ved.*?$",
    r"(?s)<svg[^>]*>.*?</svg>",
    r"<img[^>]*>",
    r"(?s)<a[^>]*>.*?</a>",
    r"<[^>]+>",
    r"Del paragraf|🔗",
    r"(?U)^\d+\s+",
    r"(?U)\s+\d+\s*$",
)


def legal_cleaned(c: C) -> Column:
    """Legal text without navigation, change notes, markup and numbers at either end."""
    out = filled(c)
    for pattern in _LEGAL:
        out = F.regexp_replace(out, pattern, "")
    return collapsed(out)


def markup_stripped(c: C) -> Column:
    """Markup as plain text, by patterns: scripts and styles go with their contents, common references are decoded."""
    out = F.regexp_replace(filled(c), r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", "")
    out = F.regexp_replace(F.regexp_replace(out, r"(?s)<!--.*?-->", ""), r"<[^>]+>", "")
    for reference, meant in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(reference), F.lit(meant))
    return out


def html_text(c: C) -> Column:
    """Markup as collapsed plain text."""
    return collapsed(markup_stripped(c))


def legal_html_text(c: C) -> Column:
    """Markup as plain text, cleaned as legal text."""
    return collapsed(legal_cleaned(markup_stripped(c)))


def section_text_cleaned(c: C) -> Column:
    """Text without note numbers and references to other places, then normalised."""
    out = F.regexp_replace(filled(c), r"(?U)\[\d+\]", "")
    out = F.regexp_replace(out, r"(?U)\(\d+\)", "")
    out = F.regexp_replace(out, r"(?U)jf\.\s*[^.]*\.", "")
    return unicode_normalized(F.regexp_replace(out, r"(?U)se\s*[^.]*\.", ""))


def references_decoded(c: C) -> Column:
    """Collapsed, then the four common character references decoded."""
    out = collapsed(c)
    for reference, meant in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        out = F.replace(out, F.lit(reference), F.lit(meant))
    return out


def preview(c: C, length: int = 200, ratio: float = 0.7) -> Column:
    """The start of a long text, cut behind its last period or space if that is late enough, with an ellipsis."""
    text = filled(c)
    head = F.substring(text, 1, length)
    # index of the last period or space, from 0; -1 without any
    last = F.length(F.regexp_extract(head, r"(?s)^(.*)[. ]", 1)) + F.when(head.rlike("[. ]"), F.lit(0)).otherwise(F.lit(-1))
    cut = F.when(last > length * ratio, F.substring(head, F.lit(1), last + 1)).otherwise(head)
    return F.when(F.length(text) <= length, text).otherwise(F.concat(cut, F.lit("...")))


def truncated(c: C, tokens: int = 250) -> Column:
    """At most four characters a token, cut before the last period, which is put back."""
    text, size = filled(c), 4 * tokens
    head = F.substring(text, 1, size)
    kept = F.regexp_replace(head, r"(?s)\.[^.]*$", "")
    cut = F.when(kept != "", F.concat(kept, F.lit("."))).otherwise(F.concat(head, F.lit("...")))
    return F.when(F.length(text) <= size, text).otherwise(cut)


# --- hashes --------------------------------------------------------------------------


def sha256_bytes(c: C) -> Column:
    """Hex digest of binary content."""
    return F.sha2(_c(c), 256)


def stable_hash(c: C, canonical: bool = False) -> Column:
    """Hex digest of a text, as it is or lower-cased and collapsed; empty for an empty text."""
    text = filled(c)
    source = collapsed(F.lower(text)) if canonical else text
    return F.when(text == "", F.lit("")).otherwise(F.sha2(source.cast("binary"), 256))


def escaped_hash(c: C) -> Column:
    """As ``stable_hash`` of the canonical text, whose UTF-8 bytes are read as Latin-1 first."""
    text = filled(c)
    source = F.decode(F.encode(collapsed(F.lower(text)), "UTF-8"), "ISO-8859-1")
    return F.when(text == "", F.lit("")).otherwise(F.sha2(F.encode(source, "UTF-8"), 256))


# --- dates ---------------------------------------------------------------------------

# Norwegian names of months and their numbers.
MONTHS = {"jan": "01", "januar": "01", "feb": "02", "februar": "02", "mar": "03", "mars": "03", "apr": "04", "april": "04", "mai": "05", "jun": "06", "juni": "06", "jul": "07", "juli": "07", "aug": "08", "august": "08", "sep": "09", "september": "09", "okt": "10", "oktober": "10", "nov": "11", "november": "11", "des": "12", "desember": "12"}
LONG_DATE = r"\d{1,2}\s+\w+\s+\d{4}"


def norwegian_date(c: C) -> Column:
    """A long date as ISO date; what can't be read stays."""
    text = filled(c)
    part = lambda i: F.regexp_extract(F.trim(text), r"(?U)^(\d{1,2})\s+(\w+)\s+(\d{4})", i)
    month = F.element_at(F.create_map(*(F.lit(x) for kv in MONTHS.items() for x in kv)), F.lower(part(2)))
    return F.when(month.isNotNull(), F.concat_ws("-", part(3), month, F.lpad(part(1), 2, "0"))).otherwise(text)


_NUMERIC = ((r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"))


def numeric_date(c: C) -> Column:
    """The first day-month-year date as ISO date; null without one that can be read.

    A date that begins with the year isn't one: of it, only a part is taken, which can't be
    read; ``iso_aware`` of ``validity_dates`` reads it.
    """
    found = F.regexp_extract(filled(c), r"(\d{1,2}[./-]\d{1,2}[./-]\d{2,4})", 1)
    read = F.coalesce(*(F.when(found.rlike(shape), F.try_to_date(found, form)) for shape, form in _NUMERIC))
    return F.date_format(read, "yyyy-MM-dd")


def validity_dates(cells: C, iso_aware: bool = False) -> Column:
    """(valid_from, valid_to) from the first dates of an array of cells; of later ones the last."""

    def read(x: Column) -> Column:
        iso = F.date_format(F.try_to_date(F.regexp_extract(x, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd"), "yyyy-MM-dd")
        return F.coalesce(iso, numeric_date(x)) if iso_aware else numeric_date(x)

    dates = F.filter(F.transform(_c(cells), read), lambda x: x.isNotNull())
    last = F.when(F.size(dates) > 1, F.element_at(dates, -1))
    return F.struct(F.get(dates, F.lit(0)).alias("valid_from"), last.alias("valid_to"))


# --- citations and terms -------------------------------------------------------------

# Forms of citations.
CITATIONS = (r"lov-\d{4}-\d{2}-\d{2}-\d+", r"§\s*\d+-\d+", r"[A-ZÆØÅ][a-zæøå]*-loven")
BRACKETED = (r"\[§\s*[\d-]+\s+[^\]]+\]", r"\[NS\s*\d+\]", r"\[Lov om [^\]]+\]", r"\[Forskrift [^\]]+\]")


def found_all(c: C, *patterns: str, group: int = 0) -> Column:
    """All matches, pattern after pattern."""
    return F.flatten(F.array(*(F.regexp_extract_all(filled(c), F.lit(p), F.lit(group)) for p in patterns)))


def citations(c: C) -> Column:
    """The distinct legal citations of a text, sorted."""
    return F.sort_array(F.array_distinct(found_all(c, *CITATIONS)))


def has_citation(c: C, account_citations: bool = False) -> Column:
    """Whether a bracketed citation occurs; ``account_citations`` also takes those with words behind the number."""
    patterns = [*BRACKETED, r"\[NS\s*\d+[^\]]*\]"] if account_citations else BRACKETED
    return filled(c).rlike("(?U)" + "|".join(f"(?:{p})" for p in patterns))


def term(c: C) -> Column:
    """The term that a heading defines; null without one."""
    heading = F.trim(filled(c))
    section = F.trim(F.regexp_extract(heading, r"(?d)§\s*[\d-]+\.?\s*(.+)", 1))
    chapter = F.trim(F.regexp_extract(heading, r"(?d)Kapittel\s+\d+\s+(.+)", 1))
    other = F.when((F.length(heading) > 10) & ~heading.startswith("§"), heading)
    return F.when(heading.rlike(r"(?d)§\s*[\d-]+\.?\s*.+"), section).when(heading.rlike(r"(?d)Kapittel\s+\d+\s+.+"), chapter).otherwise(other)


# Words of procedural sections, and of definitions.
PROCEDURAL = ("søknad", "klage", "vedtak", "frist", "innlevering", "kontrollopplysninger", "straff", "overtredelse")
DEFINING = ("definisjon", "virkeområde", "gjelder", "omfatter", "betyr", "menes")


def is_procedural(c: C) -> Column:
    return any_of(c, *PROCEDURAL)


def is_definition(heading: C, text: C) -> Column:
    """Whether the heading, or the first 200 characters of the text, speak of a definition."""
    return any_of(heading, *DEFINING) | any_of(F.substring(filled(text), 1, 200), *DEFINING)


# --- urls and fields -----------------------------------------------------------------


def is_url(c: C) -> Column:
    """Whether a text has a scheme and a host."""
    return filled(c).rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+")


def is_sha256(c: C) -> Column:
    return F.lower(filled(c)).rlike("^[a-f0-9]{64}$")


def is_missing(c: C) -> Column:
    """Whether a text is null or empty."""
    return filled(c) == ""
