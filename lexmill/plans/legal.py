"""Law sections from the blocks of a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import LONG_DATE, collapsed, escaped_hash, filled, first_match, found_all, legal_cleaned, norwegian_date, token_count, unicode_normalized
from lexmill.plans.rates import _BLOCK_COLUMNS

MIN_TEXT = 10
# Patterns of changes, tried on the lower-cased text of the page.
CHANGES = (r"endret ved (?:lov|forskrift)[^0-9]*(\d{1,2}\s+\w+\s+\d{4})", r"ikrafttredelse[^0-9]*(\d{1,2}\s+\w+\s+\d{4})", r"(\d{1,2}\s+\w+\s+\d{4})[^0-9]*(?:endret|ikrafttredelse)")
REPEALED_WORDS = ("opphevet", "repealed", "ikrafttredelse", "endret")
MENUS = ("hovedmeny", "main menu", "navigasjon")


def section_id(node_id: Column, text: Column) -> Column:
    """The element's id, else the first number of a section in the text; null without either."""
    marked, bare = F.regexp_extract(text, r"(?U)§\s*(\d+-\d+)", 1), F.regexp_extract(text, r"(?U)(\d+-\d+)", 1)
    return F.when(filled(node_id) != "", node_id).when(marked != "", F.concat(F.lit("§ "), marked)).when(bare != "", F.concat(F.lit("§ "), bare))


def parsed_sections(blocks: DataFrame, key: list[str]) -> DataFrame:
    """Sections of each page: of the elements that look like sections, else of the page's text."""
    kept = [c for c in blocks.columns if c not in _BLOCK_COLUMNS]
    found = blocks.where("kind = 'section'").withColumn("section_id", section_id(F.col("node_id"), F.col("raw")))
    found = found.where(F.col("section_id").isNotNull() & (F.length(collapsed("text")) >= MIN_TEXT))
    path = first_match([(F.col("chapter").isNotNull(), F.concat(F.lit("Kapittel "), F.col("chapter"), F.lit(" "), F.col("section_id"))), (F.col("heading") != "", F.col("heading"))], F.col("section_id"))
    first = found.select(*kept, "ord", "section_id", path.alias("path"), "heading", unicode_normalized("text").alias("text_plain"))
    # pages without any section of the first kind: cut their text at section numbers
    rest = blocks.where("kind = 'page'").join(first.select(*key).distinct(), key, "left_anti")
    cut = rest.select(*kept, F.posexplode(F.regexp_extract_all("raw", F.lit(r"(?U)(§\s*\d+-\d+[^§]*)"), 1)).alias("ord", "part"))
    cut = cut.withColumn("lines", F.split(F.trim(F.regexp_replace("part", r"(?U)^\s+|\s+$", "")), "\n")).where(F.size("lines") >= 2)
    heading, body = F.trim(F.get("lines", F.lit(0))), F.regexp_replace(F.array_join(F.slice("lines", 2, 2_000_000_000), "\n"), r"(?U)^\s+|\s+$", "")
    cut = cut.withColumns({"heading": heading, "body": body}).where(F.length("body") >= MIN_TEXT)
    cut = cut.select(*kept, "ord", F.concat(F.lit("§ "), F.regexp_extract("heading", r"(?U)§\s*(\d+-\d+)", 1)).alias("section_id"), F.col("heading").alias("path"), "heading", unicode_normalized("body").alias("text_plain"))
    return first.unionByName(cut)


def law_title(h1: Column, title: Column, fallback: Column) -> Column:
    """The first heading without the site's name and brackets; a menu's heading gives way to the page's title."""
    name = F.regexp_replace(F.trim(filled(h1)), r"\s*-\s*(Lovdata|Skatteetaten|Altinn)", "")
    name = F.regexp_replace(F.regexp_replace(name, r"\s*\([^)]*\)\s*$", ""), r"\s*\[[^\]]*\]\s*$", "")
    other = F.trim(F.get(F.split(F.trim(filled(title)), " - "), F.lit(0)))
    named = F.when((name == "") | F.lower(name).isin(*MENUS), F.when(other != "", other).otherwise(name)).otherwise(name)
    return F.when(named == "", filled(fallback)).otherwise(named)


def amendments(page: Column) -> Column:
    """The distinct changes that a page's text tells of, by date: (date, note)."""
    low = F.lower(filled(page))
    dates = F.array_sort(F.array_distinct(found_all(low, *(f"(?Uiu){p}" for p in CHANGES), group=1)))
    return F.transform(dates, lambda d: F.struct(norwegian_date(d).alias("date"), F.concat(F.lit("Amended "), d).alias("note")))


def page_metadata(blocks: DataFrame, kept: list[str]) -> DataFrame:
    """What a page tells about all its sections, once per page."""
    low = F.lower(filled("context"))
    chapter = r"(?Us)^Kapittel\s+(\d+)[\s\.]*([^§]*?)(?:§.*|$)"
    hit = F.get(F.filter(F.coalesce("cells", F.array().cast("array<string>")), lambda x: x.rlike(r"(?U)^Kapittel\s+\d+")), F.lit(0))
    return blocks.where("kind = 'page'").select(
        *kept,
        F.col("text").alias("page_h1"),
        F.col("text_plain").alias("page_title"),
        F.regexp_extract(filled(hit), chapter, 1).alias("page_chapter_no"),
        F.regexp_replace(collapsed(F.regexp_extract(filled(hit), chapter, 2)), r"\.$", "").alias("page_chapter_title"),
        (low.contains("opphevet") & (low.contains("ved") | low.contains("forskrift"))).alias("page_repealed"),
        F.regexp_extract(low, f"(?U)({LONG_DATE})", 1).alias("page_date"),
        amendments(F.col("raw")).alias("amendments"),
        F.col("raw").alias("page_text"),
    )


def sections(blocks: DataFrame, key: list[str], source: dict[str, str] | None = None) -> DataFrame:
    """Law sections with the page's and the source's metadata.

    ``key`` identifies a page.  Source columns (``law_id``, ``url``, ``title``, ``domain``,
    …) are taken from the blocks' other columns, by the names that ``source`` gives.
    """
    names = {c: c for c in ("source_id", "url", "title", "domain", "source_type", "publisher", "version", "jurisdiction", "effective_from", "effective_to", "crawl_freq")} | (source or {})
    kept = [c for c in blocks.columns if c not in _BLOCK_COLUMNS]
    column = lambda name, default=None: F.coalesce(F.nullif(F.trim(F.col(names[name]).cast("string")), F.lit("")), F.lit(default)) if names[name] in kept else F.lit(default).cast("string")
    rows = parsed_sections(blocks, key).join(page_metadata(blocks, key), key)
    # cleaned twice, as the number at either end that the first pass uncovers goes too
    text = legal_cleaned(legal_cleaned("text_plain"))
    rows = rows.withColumns({"raw_text": F.col("text_plain"), "text_plain": text})
    own = F.col("heading").contains("(Opphevet)")
    stated = F.coalesce(
        *(F.nullif(F.regexp_extract("text_plain", p, 1), F.lit("")) for p in (rf"(?Ui)ikr\.\s+({LONG_DATE})", rf"(?Ui)i\s+kraft\s+({LONG_DATE})", rf"(?U)({LONG_DATE})"))
    )
    date = F.when(own, stated).when(F.col("page_repealed"), F.nullif(F.col("page_date"), F.lit("")))
    from_path = F.regexp_extract("path", r"(?U)^Kapittel\s+(\d+)\s+", 1)
    number = F.when(from_path != "", from_path).otherwise(F.col("page_chapter_no"))
    heading = F.when(from_path != "", F.lit("")).otherwise(F.col("page_chapter_title"))
    chapter = first_match([((number != "") & (heading != ""), F.concat(F.lit("Kapittel "), number, F.lit(". "), heading)), (number != "", F.concat(F.lit("Kapittel "), number))], F.lit(""))
    return rows.select(
        *key,
        column("source_id").alias("law_id"),
        "section_id",
        F.when(F.col("section_id").startswith("PARAGRAF_"), F.concat(F.lit("§ "), F.substring("section_id", 10, 1000))).otherwise(F.col("section_id")).alias("section_label"),
        "path",
        "heading",
        "text_plain",
        column("url", "").alias("source_url"),
        escaped_hash("raw_text").alias("sha256"),
        column("domain", "unknown").alias("domain"),
        column("source_type", "unknown").alias("source_type"),
        column("publisher", "unknown").alias("publisher"),
        column("version", "current").alias("version"),
        column("jurisdiction", "NO").alias("jurisdiction"),
        column("effective_from").alias("effective_from"),
        column("effective_to").alias("effective_to"),
        law_title(F.col("page_h1"), F.col("page_title"), column("title", "")).alias("law_title"),
        number.alias("chapter_no"),
        heading.alias("chapter_title"),
        chapter.alias("chapter"),
        (own | F.col("page_repealed")).alias("repealed"),
        F.when(date.isNotNull(), norwegian_date(date)).alias("repeal_date"),
        "amendments",
        F.lit(True).alias("is_current"),
        token_count("text_plain").alias("token_count"),
        F.length("text_plain").alias("text_length"),
        column("crawl_freq", "unknown").alias("crawl_freq"),
        "ord",
    )


def plain_metadata(blocks: DataFrame, kept: list[str]) -> DataFrame:
    """The older reading of a page: its title, its chapter heading, repealed at any word of change, dates of changes."""
    low = F.lower(filled("raw"))
    repealed = F.lit(False)
    for word in REPEALED_WORDS:
        repealed = repealed | low.contains(word)
    chapter = F.when(F.lower("chapter").rlike("kapittel|chapter"), F.col("chapter"))
    dates = F.array_sort(F.array_distinct(found_all(low, *(f"(?Uiu){p}" for p in CHANGES), group=1)))
    return blocks.where("kind = 'page'").select(*kept, F.nullif(F.col("heading"), F.lit("")).alias("law_title"), chapter.alias("chapter"), repealed.alias("repealed"), dates.alias("amended_dates"))
